"""A stored full-text index: postings clustered by term, in segments that are added and merged.

Postings lie in one folder per segment and bucket of terms, sorted by term, so that a search reads its terms' buckets and in them the
row groups that may hold the terms. Beside each segment are the number of documents of each term and the length of each
document. Changed and removed documents get a new segment and marks against the older ones; `merge` makes one segment of all.
A version note names the segments and marks that count.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..sources import versions
from . import search

FIELDS = ("title", "description", "company", "location")
BUCKETS = 16


def _bucket(term: str, buckets: int) -> int:
    return zlib.crc32(term.encode()) % buckets


def _read(spark: SparkSession, folder: str, kind: str, segments: Sequence[int], schema: dict | None = None) -> DataFrame:
    base = f"{folder}/{kind}"
    reader = spark.read.option("basePath", base)
    if schema:  # a segment without rows has no files to tell
        reader = reader.schema(T.StructType.fromJson(schema).add("segment", T.IntegerType()))
    return reader.parquet(*[f"{base}/segment={s}" for s in segments])


def _write_segment(index: DataFrame, folder: str, number: int, buckets: int) -> tuple[dict, dict]:
    """Postings, then what is counted from them; returns the segment's part of the note, and the schema of the postings.

    Each task sorts the postings it has and writes a file of each bucket, so postings are not shuffled and a frequent term spreads over
    several files of its bucket. Lengths are read off the one posting of each document that leads.
    """
    spark = index.sparkSession
    part = f"segment={number}"
    rows = index.withColumn("bucket", (F.crc32(F.col("term").cast("binary")) % buckets).cast("int"))
    rows = rows.sortWithinPartitions("bucket", "term", "doc_id")
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/postings/{part}")
    stored = spark.read.schema(rows.schema).parquet(f"{folder}/postings/{part}")
    counts = stored.groupBy("term").agg(F.count("*").alias("docs"))
    counts.hint("rebalance").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{folder}/terms/{part}")
    stored.filter("lead").select("doc_id", "length").write.mode("overwrite").parquet(f"{folder}/lengths/{part}")
    docs, words = spark.read.parquet(f"{folder}/lengths/{part}").agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    return {"segment": number, "docs": docs, "words": words}, rows.schema.jsonValue()


class TextIndex:
    """One version of a stored index."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        note = versions.current(spark, folder)
        if note is None:
            raise ValueError(f"no index at {folder}")
        self.spark, self.folder, self.note = spark, folder, note
        self.segments = [s["segment"] for s in note["segments"]]

    def terms(self, text: str | Sequence[str]) -> list[str]:
        """Words of a query as this index holds them."""
        return search.query_terms(text, stemmed=self.note["stemmed"])

    def rows(self, terms: Sequence[str] | None = None) -> DataFrame:
        """Postings of documents as they are now; with `terms` only their buckets and row groups are read."""
        rows = _read(self.spark, self.folder, "postings", self.segments, self.note["schema"])
        if terms is not None:
            wanted = sorted({_bucket(t, self.note["buckets"]) for t in terms})
            rows = rows.filter(F.col("bucket").isin(wanted) & F.col("term").isin(sorted(set(terms))))
        return self._alive(rows).drop("segment", "bucket")

    def _alive(self, rows: DataFrame) -> DataFrame:
        if not self.note["marks"]:
            return rows
        marks = self.spark.read.parquet(*[f"{self.folder}/marks/{n}" for n in self.note["marks"]])
        return rows.join(marks, ["segment", "doc_id"], "left_anti")

    def lengths(self) -> DataFrame:
        return self._alive(_read(self.spark, self.folder, "lengths", self.segments))

    def counts(self, terms: Sequence[str]) -> dict[str, int]:
        """Number of documents of each term of a query; counted anew only while documents are marked."""
        if self.note["marks"]:
            found = self.rows(terms).groupBy("term").agg(F.count("*").alias("docs"))
        else:
            found = _read(self.spark, self.folder, "terms", self.segments).filter(F.col("term").isin(sorted(set(terms)))).groupBy("term").agg(F.sum("docs").alias("docs"))
        return {r["term"]: r["docs"] for r in found.collect()}

    def ranked(self, text: str | Sequence[str]) -> DataFrame:
        """Documents holding every word of a query, scored: (doc_id, rank, and stamp if the index keeps one)."""
        terms, total = self.terms(text), self.note["docs"]
        return search.score_hits(self.rows(terms), terms, total, self.note["words"] / max(total, 1), self.counts(terms))

    def best(self, text: str | Sequence[str], limit: int, inside: DataFrame | None = None, key: str = "id") -> DataFrame:
        """The best documents, newer first on equal rank; `inside` holds the only rows that may be found.

        Each task keeps its own best ones, so that no more than `limit` rows of each meet.
        """
        hits = self.ranked(text)
        if inside is not None:
            hits = hits.join(inside.select(F.col(key).alias("doc_id")), "doc_id", "left_semi")
        newest = [F.col("stamp").desc()] if "stamp" in hits.columns else []
        return hits.orderBy("rank", *newest, "doc_id").limit(limit)

    def having(self, *, every: Sequence[str] = (), some: Sequence[str] = (), none: Sequence[str] = (), groups: Sequence[Sequence[str]] = ()) -> DataFrame:
        """Documents by which words they hold; see `search.boolean_search`."""
        every, some, none = self.terms(every), self.terms(some), self.terms(none)
        groups = [self.terms(g) for g in groups]
        asked = [*every, *some, *none, *[t for g in groups for t in g]]
        return search.boolean_search(self.rows(asked), every, some, none, groups)

    def matching(self, text: str) -> DataFrame:
        """The keys of documents with every word of a query that is no stop word, as a filter for a job search."""
        wanted = [w for w in search.query_terms(text, stemmed=False) if w not in fixed.STOP_WORDS]
        return self.having(every=wanted).withColumnRenamed("doc_id", self.note["key"])

    def phrase(self, text: str) -> DataFrame:
        terms = self.terms(text)
        return search.phrase_search(self.rows(terms), terms)

    def near(self, left: str, right: str, distance: int = 10) -> DataFrame:
        (left,), (right,) = self.terms(left), self.terms(right)
        return search.near_search(self.rows([left, right]), left, right, distance)

    def in_field(self, field: str, word: str) -> DataFrame:
        (term,) = self.terms(word)
        return search.field_search(self.rows([term]), field, term)


def create(rows: DataFrame, folder: str, fields: Sequence[str] = FIELDS, key: str = "id", stemmed: bool = True, stamp: str | None = None,
           buckets: int = BUCKETS) -> TextIndex:
    """Write the first segment of an index over a table."""
    spark = rows.sparkSession
    segment, schema = _write_segment(search.build_index(rows, fields, key, stemmed, stamp), folder, 1, buckets)
    versions.publish(spark, folder, {"segments": [segment], "marks": [], "docs": segment["docs"], "words": segment["words"], "next": 2,
                                     "fields": list(fields), "key": key, "stemmed": stemmed, "stamp": stamp, "buckets": buckets, "schema": schema})
    return TextIndex(spark, folder)


def update(index: TextIndex, changed: DataFrame, removed: DataFrame | None = None) -> TextIndex:
    """Take new and changed rows in as one more segment; `removed` holds the ids of rows that are gone.

    Only the batch's own postings are written. Of the rest the lengths alone are read, to find the documents that are marked.
    """
    spark, folder, note = index.spark, index.folder, index.note
    number = note["next"]
    segment, _ = _write_segment(search.build_index(changed, note["fields"], note["key"], note["stemmed"], note["stamp"]), folder, number, note["buckets"])
    ids = changed.select(F.col(note["key"]).alias("doc_id"))
    if removed is not None:
        ids = ids.unionByName(removed.select(F.col(note["key"]).alias("doc_id")))
    index.lengths().join(ids, "doc_id", "left_semi").select("segment", "doc_id", "length").write.mode("overwrite").parquet(f"{folder}/marks/{number}")
    docs, words = spark.read.parquet(f"{folder}/marks/{number}").agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    versions.publish(spark, folder, note | {
        "segments": [*note["segments"], segment], "marks": note["marks"] + [number] * (docs > 0), "next": number + 1,
        "docs": note["docs"] - docs + segment["docs"], "words": note["words"] - words + segment["words"]})
    return TextIndex(spark, folder)


def merge(index: TextIndex, keep: int = 2) -> TextIndex:
    """One segment of all that count, without marks; versions older than the last `keep` are removed."""
    spark, folder, note = index.spark, index.folder, index.note
    segment, _ = _write_segment(index.rows(), folder, note["next"], note["buckets"])
    versions.publish(spark, folder, note | {"segments": [segment], "marks": [], "docs": segment["docs"], "words": segment["words"], "next": note["next"] + 1})
    versions.clean(spark, folder, _paths, keep)
    return TextIndex(spark, folder)


def _paths(note: dict) -> list[str]:
    parts = [f"{kind}/segment={s['segment']}" for s in note["segments"] for kind in ("postings", "terms", "lengths")]
    return parts + [f"marks/{n}" for n in note["marks"]]
