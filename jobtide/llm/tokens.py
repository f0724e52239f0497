"""Exact token counts from a histogram of encoded document lengths."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .encode import DEFAULT_TOKENIZER, encoder, slices
from .words import text_bytes

STEP = 1024


def length_histogram(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """Number of documents of each encoded length: (tokens, n_docs).

    Needs `text`; other columns are ignored. Null and empty texts have no token; repeated rows count each; an empty
    table has an empty histogram. Lengths are counted inside each batch before anything is shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            texts, seen = text_bytes(batch.column(0)), Counter()
            for part in slices(texts):
                seen.update(len(ids) // 4 for ids in encode.texts(texts[part]))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["tokens", "n_docs"])

    return docs.select("text").mapInArrow(run, "tokens long, n_docs long").groupBy("tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per length: documents and tokens at this length or longer, below it, and the corpus total if texts are cut here.

    Sums run inside steps of 1,024 lengths; only the steps' totals meet in one window.
    """
    step = F.floor(F.col("tokens") / STEP)
    rows = histogram.withColumn("_step", step).withColumn("_tokens", F.col("tokens") * F.col("n_docs"))
    steps = rows.groupBy("_step").agg(F.sum("n_docs").alias("_d"), F.sum("_tokens").alias("_t"))
    over = Window.orderBy(F.desc("_step")).rowsBetween(Window.unboundedPreceding, -1)
    under = Window.orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.select("_step", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}{n}") for c in ("_d", "_t") for n, w in (("_over", over), ("_under", under))])
    up = Window.partitionBy("_step").orderBy(F.desc("tokens")).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("_step").orderBy("tokens").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.join(steps, "_step").select(
        "tokens", "n_docs", F.col("_tokens").alias("n_tokens"),
        (F.sum("n_docs").over(up) + F.col("_d_over")).alias("docs_from"), (F.sum("_tokens").over(up) + F.col("_t_over")).alias("tokens_from"),
        (F.sum("n_docs").over(down) + F.col("_d_under")).alias("docs_to"), (F.sum("_tokens").over(down) + F.col("_t_under")).alias("tokens_to"))
    cut = F.col("tokens_to") + F.col("tokens") * (F.col("docs_from") - F.col("n_docs"))
    return sums.withColumn("truncated_total", cut)


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """The corpus total for any context limits: one row per limit, from one pass over the histogram."""
    cut = histogram.agg(*[F.coalesce(F.sum(F.least("tokens", F.lit(x)) * F.col("n_docs")), F.lit(0)).alias(f"_{i}") for i, x in enumerate(limits)])
    rows = F.explode(F.array(*[F.struct(F.lit(x).cast("long").alias("context_limit"), F.col(f"_{i}").alias("total")) for i, x in enumerate(limits)]))
    return cut.select(rows.alias("_x")).select("_x.*")


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """For each share the smallest length that at least that share of the documents does not exceed."""
    total = F.col("docs_from") + F.col("docs_to") - F.col("n_docs")
    found = sums.agg(*[F.min(F.when(F.col("docs_to") >= F.lit(q) * total, F.col("tokens"))).alias(f"_{i}") for i, q in enumerate(shares)])
    rows = F.explode(F.array(*[F.struct(F.lit(q).alias("share"), F.col(f"_{i}").alias("tokens")) for i, q in enumerate(shares)]))
    return found.select(rows.alias("_x")).select("_x.*")
