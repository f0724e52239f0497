"""The corpus pipeline: filter, keep one of each group of near copies, decontaminate, redact, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again for the next one. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import catalog, decontaminate, frames, packing, pii, simhash, toxicity
from jobtide.session import kept


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half; the model learns from the labelled ones among them."""
    model = toxicity.train(docs, catalog.table(spark, sf_dir, "labels"), F.lit(True))
    scored = toxicity.score(frames.numbered(docs, "text"), model)  # no column of the input can clash with the score
    return frames.restored(scored.filter(F.col("toxicity") < 0.5), docs.columns, "text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints at two bits or fewer."""
    return simhash.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, catalog.table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced by its kind."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in a sequence."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("personal_data", hide_personal_data),
    ("packing", pack),
]
ORACLE_SQL = None  # a kernel machine, tokenizer files and alignments are beyond SQL; tests/llm has the brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = catalog.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
