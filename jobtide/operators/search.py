"""Full-text search over posting tables.

An index is an ordinary table with one row per term and document (term, doc_id, tf, length, hits, lead); `hits` holds the field and
position of each occurrence, `length` the number of words of the document, and `lead` is true in one row of each document. Queries are structured arguments. `text_index`
keeps such a table on disk, clustered by term.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from math import log
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.core import lookup
from ..functions.stem import known_stem, stem
from ..functions.text import ACCENTED, PLAIN, fold

WORD = r"[\p{L}\p{N}]+"
K1, B = 1.2, 0.75
LEAST_IDF = 1e-6


def words(c: Column) -> Column:
    return F.regexp_extract_all(fold(F.coalesce(c, F.lit(""))), F.lit(WORD), F.lit(0))


def query_terms(text: str | Sequence[str], stemmed: bool = True) -> list[str]:
    """Words of a query in index form."""
    import re

    parts = text.split() if isinstance(text, str) else list(text)
    table = str.maketrans(ACCENTED, PLAIN)
    tokens = [w for p in parts for w in re.findall(r"[^\W_]+", p.lower().translate(table))]
    return [stem(w) if stemmed else w for w in tokens]


TEXT_PER_TASK = 8 << 20  # bytes of text whose postings one task sorts in memory; they take some forty times as much there
TOKENS = 1 << 19  # words that are grouped at once, if they are of more than one document


def _token_slices(batch: pa.RecordBatch, lists: list[int]) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded number of words in their lists."""
    sizes = sum(pc.list_value_length(batch.column(i)).to_numpy(zero_copy_only=False).astype(np.int64) for i in lists)
    ends, lo = np.cumsum(sizes), 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + TOKENS, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _postings(batch: pa.RecordBatch, fields: Sequence[str], lists: list[int], stemmed: bool) -> dict[str, pa.Array]:
    """The words of some documents, one entry for each document and term; the work is that of one sort."""
    owners, places, tokens = [], [], []
    order = sorted(range(len(fields)), key=lambda i: fields[i])
    for i in order:
        column = batch.column(lists[i])
        sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
        owners.append(np.repeat(np.arange(batch.num_rows), sizes))
        places.append(np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
        tokens.append(column.flatten())
    field = np.repeat(np.arange(len(order)), [len(t) for t in tokens])
    owner, place = np.concatenate(owners), np.concatenate(places)
    coded = pa.concat_arrays(tokens).dictionary_encode()
    code, terms = coded.indices.to_numpy(), coded.dictionary
    if stemmed:
        stems = pa.array([known_stem(w) for w in terms.to_pylist()], terms.type).dictionary_encode()
        code, terms = stems.indices.to_numpy()[code], stems.dictionary
    by = np.argsort(owner * max(len(terms), 1) + code, kind="stable")  # fields and places stay in order
    owner, code = owner[by], code[by]
    new = np.ones(len(by), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (code[1:] != code[:-1])
    starts = np.flatnonzero(new)
    mine = owner[starts]
    names = pa.array([fields[i] for i in order], pa.string()).take(pa.array(field[by]))
    hits = pa.StructArray.from_arrays([names, pa.array(place[by].astype(np.int32))], names=["field", "pos"])
    offsets = pa.array(np.append(starts, len(by)).astype(np.int32))
    lead = np.ones(len(mine), bool)
    lead[1:] = mine[1:] != mine[:-1]
    rows = pa.array(mine)
    return {"term": terms.take(pa.array(code[starts])), "doc_id": batch.column(0).take(rows), "tf": pa.array(np.diff(np.append(starts, len(by)))),
            "length": pa.array(np.bincount(owner, minlength=batch.num_rows)[mine]), "hits": pa.ListArray.from_arrays(offsets, hits),
            "stamp": batch.column(1).take(rows), "lead": pa.array(lead)}


def build_index(df: DataFrame, fields: Sequence[str] = ("title", "description", "company", "location"),
                key: str = "id", stemmed: bool = True, stamp: str | None = None) -> DataFrame:
    """Postings of every word of every field; `stamp` names a date that is kept beside them for ordering.

    A document's words are grouped, and stemmed, where its row is: texts are dealt over tasks by their size, and postings are never shuffled. Rows that share
    their key are one document; they are found first, and their postings alone are brought together. `lead` marks one posting of each document.
    """
    stamps = ["stamp"] if stamp else []
    texts = df.select(F.col(key).alias("doc_id"), *[F.col(stamp).alias("stamp") for _ in stamps], *[F.col(f).alias(f"_{i}") for i, f in enumerate(fields)])
    size = sum((F.coalesce(F.octet_length(f"_{i}"), F.lit(0)) for i in range(len(fields))), F.lit(0).cast("long"))
    ids = texts.groupBy("doc_id").agg(F.count("*").alias("_copies"), F.sum(size).alias("_size"))
    most, total = ids.agg(F.max("_copies"), F.sum("_size")).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-(total or 0) // TEXT_PER_TASK), min(cores, (total or 0) // (1 << 20)), 1)

    def inside(rows: DataFrame) -> DataFrame:
        rows = rows.select("doc_id", *stamps, *[words(F.col(f"_{i}")).alias(f"_{i}") for i in range(len(fields))])
        hits = T.ArrayType(T.StructType([T.StructField("field", T.StringType()), T.StructField("pos", T.IntegerType())]))
        kinds = {"term": T.StringType(), "doc_id": rows.schema["doc_id"].dataType, "tf": T.LongType(), "length": T.LongType(), "hits": hits,
                 **{c: rows.schema[c].dataType for c in stamps}, "lead": T.BooleanType()}
        lists = list(range(1 + len(stamps), 1 + len(stamps) + len(fields)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in _token_slices(batch, lists):
                    found = _postings(part, fields, lists, stemmed)
                    yield pa.RecordBatch.from_arrays([found[k] for k in kinds], names=list(kinds))

        return rows.mapInArrow(run, T.StructType([T.StructField(k, t) for k, t in kinds.items()]))

    if (most or 0) < 2:
        return inside(texts.repartition(parts))
    shared = ids.filter("_copies > 1").select(F.col("doc_id").alias("_shared"))
    same = F.col("doc_id").eqNullSafe(F.col("_shared"))
    several = inside(texts.join(shared, same, "left_semi").repartition(parts)).groupBy("doc_id", "term").agg(
        F.sum("tf").alias("tf"), *[F.first(c).alias(c) for c in ("length", *stamps)], F.sort_array(F.flatten(F.collect_list("hits"))).alias("hits"))
    longest = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("length").desc(), "term"))
    several = several.withColumn("lead", longest == 1)
    single = inside(texts.join(shared, same, "left_anti").repartition(parts))
    return single.unionByName(several.select(*single.columns))


def field_postings(index: DataFrame) -> DataFrame:
    """Postings per document, field and term, with the positions; an index has one row per term and document, which is split by field."""
    places = lambda f: F.transform(F.filter("hits", lambda h: h["field"] == f), lambda h: h["pos"])
    split = F.transform(F.array_distinct("hits.field"), lambda f: F.struct(f.alias("field"), F.sort_array(places(f)).alias("positions")))
    rows = index.select("doc_id", "term", F.inline_outer(split)).filter("field is not null")
    return rows.select("doc_id", "field", "term", F.size("positions").cast("long").alias("tf"), "positions")


def index_lengths(index: DataFrame) -> DataFrame:
    """Number of words per document; stored beside the index."""
    return index.groupBy("doc_id").agg(F.max("length").alias("length"))


def score_hits(hits: DataFrame, terms: Sequence[str], total: int, mean: float, found: dict[str, int]) -> DataFrame:
    """Documents holding every term, with the BM25 score (Robertson and Zaragoza, 2009).

    `hits` has the postings of the terms, `found` the number of documents of each. A posting brings all that its share of the score
    needs, so a document's score is one sum and needs no other table. A document is scored over all of its fields. `rank` is
    the negative score, so the best row comes first in ascending order.
    """
    terms = list(dict.fromkeys(terms))
    idf = {t: max(log((total - n + 0.5) / (n + 0.5)), LEAST_IDF) for t in terms if (n := found.get(t, 0))}
    size = K1 * (1 - B + B * F.col("length") / F.lit(mean or 1.0))
    part = lookup(idf, F.col("term")) * (F.col("tf") * (K1 + 1)) / (F.col("tf") + size) if idf else F.lit(0.0)
    shares = hits.filter(F.col("term").isin(terms)).withColumn("_part", part)
    stamp = [F.max("stamp").alias("stamp")] if "stamp" in hits.columns else []
    scored = shares.groupBy("doc_id").agg(F.count("*").alias("_n"), (-F.sum("_part")).alias("rank"), *stamp)
    return scored.filter(F.col("_n") == len(terms)).drop("_n")


def ranked_search(index: DataFrame, lengths: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Documents of an index table holding every term, scored by `score_hits`; sizes are counted first."""
    total, mean = lengths.agg(F.count("*"), F.avg("length")).first()
    hits = index.filter(F.col("term").isin(list(terms)))
    found = {r["term"]: r["count"] for r in hits.groupBy("term").count().collect()}  # a row per query term
    return score_hits(hits, terms, total, mean, found)


def best_hits(hits: DataFrame, jobs: DataFrame, limit: int, key: str = "id",
              date: str = "posted_date") -> DataFrame:
    """Best ranked rows of a table, newer first on equal rank."""
    return (hits.join(jobs.withColumnRenamed(key, "doc_id"), "doc_id")
            .orderBy("rank", F.col(date).desc(), "doc_id").limit(limit))


def boolean_search(index: DataFrame, every: Sequence[str] = (), some: Sequence[str] = (),
                   none: Sequence[str] = (), groups: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Documents with all of one list, any of another, any of each further group and none of a last list."""
    groups = [list(g) for g in (*[[t] for t in every], *([some] if some else []), *groups)]
    if not groups:
        raise ValueError("a search needs at least one wanted term")
    test = reduce(and_, [F.bool_or(F.col("term").isin(g)) for g in groups])
    if none:
        test = test & ~F.bool_or(F.col("term").isin(list(none)))
    asked = sorted({t for g in groups for t in g} | set(none))
    return index.filter(F.col("term").isin(asked)).groupBy("doc_id").agg(test.alias("_hit")).filter("_hit").select("doc_id")


def _occurrences(index: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Field and position of every occurrence of the terms."""
    return index.filter(F.col("term").isin(sorted(set(terms)))).select("doc_id", "term", F.inline("hits"))


def phrase_search(index: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Documents with the terms next to each other, in order, inside one field.

    An occurrence of the i-th term votes for a phrase that starts i words before it; a phrase is a start with every vote. The
    work is linear in the occurrences of the terms.
    """
    places = F.array_compact(F.array(*[F.when(F.col("term") == t, F.lit(i)) for i, t in enumerate(terms)]))
    votes = _occurrences(index, terms).select("doc_id", "field", "pos", F.explode(places).alias("_place"))
    starts = votes.groupBy("doc_id", "field", F.col("pos") - F.col("_place")).agg(F.count("*").alias("_votes"))
    return starts.filter(F.col("_votes") == len(terms)).select("doc_id").distinct()


def near_search(index: DataFrame, left: str, right: str, distance: int = 10) -> DataFrame:
    """Documents with two terms at most `distance` words apart, in either order.

    One sweep along the occurrences of both terms compares each with the last one of the other term.
    """
    before = Window.partitionBy("doc_id", "field").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    last = lambda t: F.last(F.when(F.col("term") == t, F.col("pos")), ignorenulls=True).over(before)
    other = F.when(F.col("term") == left, last(right)).otherwise(last(left))
    swept = _occurrences(index, [left, right]).withColumn("_apart", F.col("pos") - other)
    return swept.filter(F.col("_apart") <= distance + 1).select("doc_id").distinct()


def field_search(index: DataFrame, field: str, term: str) -> DataFrame:
    """Documents with a term in one field."""
    return index.filter((F.col("term") == term) & F.exists("hits", lambda h: h["field"] == field)).select("doc_id")


def substring_search(jobs: DataFrame, query: str,
                     fields: Sequence[str] = ("title", "description", "company", "location")) -> DataFrame:
    """Rows where every word of the query is inside some field, without an index."""
    found = jobs
    for part in query.split():
        hit = F.lit(False)
        for f in fields:
            hit = hit | F.coalesce(F.col(f).ilike(f"%{part}%"), F.lit(False))
        found = found.filter(hit)
    return found


def filtered_search(index: DataFrame, lengths: DataFrame, jobs: DataFrame, terms: Sequence[str],
                    limit: int) -> DataFrame:
    """Ranked search inside an already filtered table."""
    return best_hits(ranked_search(index, lengths, terms), jobs, limit)


def all_terms_search(index: DataFrame, jobs: DataFrame, terms: Sequence[str], limit: int) -> DataFrame:
    """Rows holding every stemmed term, last seen first."""
    hits = boolean_search(index, every=list(dict.fromkeys(terms)))
    return (jobs.join(hits.withColumnRenamed("doc_id", "id"), "id", "left_semi")
            .orderBy(F.col("last_seen_at").desc(), F.col("id").desc()).limit(limit))
