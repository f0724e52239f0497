"""Raw postings to the next job table, for one source or many at once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.classify import classification, fill_from_class
from ..functions.normalize import location_label, normalize_title, parse_location
from ..functions.salary import annualize_salary
from ..functions.text import content_hash
from ..operators.aggregate import batch_statistics, run_statistics
from ..operators.dedup import match_by_keys, match_index, match_keys
from ..operators.filters import compliance
from ..operators.lifecycle import upsert_jobs
from ..operators.similarity import find_near_duplicates
from ..session import kept

#: How stored texts are compared where nothing else is said: the most used terms, a least corpus, a least length.
NEAR = {"threshold": 0.75, "max_features": 5000, "min_corpus": 25, "min_length": 50, "stop_words": fixed.STOP_WORDS}


def normalise(jobs: DataFrame, rows: Column | None = None) -> DataFrame:
    """Normalised title, location and salary; a remote location sets a missing remote type.

    With `rows` only the rows that meet the condition change.
    """
    rows = F.lit(True) if rows is None else rows
    df = jobs.withColumn("title", F.when(rows, normalize_title("title")).otherwise(F.col("title")))
    has_place = rows & (F.coalesce("location", F.lit("")) != "")
    df = df.withColumn("_place", F.when(has_place, parse_location("location")))
    has_salary = rows & ((F.coalesce("salary_min", F.lit(0)) != 0) | (F.coalesce("salary_max", F.lit(0)) != 0))
    df = df.withColumn("_pay", F.when(has_salary, annualize_salary(
        "salary_min", "salary_max", F.lit("yearly"), F.coalesce("salary_currency", F.lit("USD")))))
    pay = lambda field, old: F.when(has_salary, F.col(f"_pay.{field}")).otherwise(F.col(old))
    return (
        df.withColumn("remote_type", F.coalesce(
            F.nullif("remote_type", F.lit("")), F.when(has_place & F.col("_place.is_remote"), "remote")))
        .withColumn("location", F.when(has_place, location_label("_place")).otherwise(F.col("location")))
        .withColumns({"salary_min": pay("min_yearly", "salary_min"), "salary_max": pay("max_yearly", "salary_max"),
                      "salary_currency": F.when(has_salary, "USD").otherwise(F.col("salary_currency"))})
        .drop("_place", "_pay"))


def _repeats(keys: DataFrame) -> DataFrame:
    """Rows whose external id or URL an earlier row of the batch has."""
    keys = keys.filter("kind <> 'hash'")
    owners = keys.groupBy("rank", "kind", "key").agg(F.min("id").alias("_first"))
    return keys.join(owners, ["rank", "kind", "key"]).filter("_first < id").select(F.col("id").alias("duplicate_id")).distinct()


def gated(raw: DataFrame, sources: DataFrame) -> DataFrame:
    """Raw rows with an id, their hash, and why their source may not be processed, if so."""
    gate = compliance(sources).select(F.col("id").alias("source_id"), F.coalesce("reason", F.lit("")).alias("_reason"))
    return (
        raw.join(gate, "source_id", "left")
        .withColumn("blocked_reason", F.nullif(F.coalesce("_reason", F.lit("Source is not registered")), F.lit("")))
        .withColumn("id", F.col("seq")).withColumn("content_hash", content_hash("title", "company", "location")).drop("_reason"))


def asked_keys(rows: DataFrame) -> DataFrame:
    """Match keys of gated rows that are not blocked; made once for the steps that follow."""
    return kept(match_keys(rows.filter("blocked_reason is null"), "id"), "match-keys")


def matches_of(keys: DataFrame, index: DataFrame) -> DataFrame:
    """Ids of the rows whose match keys an index holds or that repeat an earlier row."""
    return match_by_keys(keys, index).select("duplicate_id").unionByName(_repeats(keys)).distinct()


def exact_matches(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Ids of gated rows that a match index holds or that repeat an earlier row; match keys are made once."""
    return matches_of(asked_keys(rows), index)


def finished(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Gated rows with their outcome; the accepted ones get their final fields."""
    matched = matches.select(F.col("duplicate_id").alias("id"), F.lit(True).alias("_dup")).distinct()
    told = rows.join(matched, "id", "left").withColumn(
        "outcome", F.when(F.col("blocked_reason").isNotNull(), "blocked").when(F.col("_dup"), "skipped").otherwise("accepted"))
    accepted = F.col("outcome") == "accepted"
    # Rejected rows keep their raw fields; their text is never looked at.
    done = normalise(told.drop("_dup", "id"), accepted).withColumn(
        "class", F.when(accepted, classification("title", "description", "location")))
    return fill_from_class(done).withColumn("level", F.col("class.experience_level")).drop("class").withColumn(
        "content_hash", content_hash("title", "company", "location"))


def process(raw: DataFrame, base: DataFrame, sources: DataFrame, near: bool = True, **near_options) -> DataFrame:
    """Every raw row with its `outcome` and, if accepted, its final fields.

    Outcomes: blocked (the source may not be processed; `blocked_reason` says why), skipped
    (duplicate), accepted. `raw` carries its arrival order in `seq`. A row repeats an
    earlier one of the batch when it shares the external id or URL. With `near` a row whose text is close to a stored one is
    skipped too; the options are those of `find_near_duplicates`.
    """
    rows = gated(raw, sources)
    matches = exact_matches(rows, match_index(base))
    if near:
        matches = kept(matches, "exact-matches")
        rest = rows.filter("blocked_reason is null").join(matches.select(F.col("duplicate_id").alias("id")), "id", "left_anti")
        found = find_near_duplicates(rest.select("id", "description"), base.select("id", "description"), **(NEAR | near_options))
        matches = matches.unionByName(found.select("duplicate_id"))
    return finished(rows, matches)


def next_table(processed: DataFrame, base: DataFrame, now: datetime) -> DataFrame:
    """Job table after the accepted rows, with an `action` per row."""
    return upsert_jobs(base, processed.filter("outcome = 'accepted'"), now)


def outcomes(processed: DataFrame, base: DataFrame) -> DataFrame:
    """Accepted rows told apart as inserted (first of an unknown hash) or updated."""
    first = processed.filter("outcome = 'accepted'").groupBy("content_hash").agg(F.min("seq").alias("_first"))
    known = base.select("content_hash").distinct().withColumn("_known", F.lit(True))
    told = processed.join(first, "content_hash", "left").join(known, "content_hash", "left")
    new = F.col("_known").isNull() & (F.col("seq") == F.col("_first"))
    return told.withColumn("outcome", F.when(F.col("outcome") != "accepted", F.col("outcome"))
                           .when(new, "inserted").otherwise("updated")).drop("_first", "_known")


def run_report(processed: DataFrame, base: DataFrame) -> DataFrame:
    """Statistics per source; a source that may not be processed shows as an error and not as a failure of the run."""
    told = outcomes(processed, base)
    stats = run_statistics(told.filter("outcome <> 'blocked'"))
    blocked = told.groupBy("source_id").agg(F.max("blocked_reason").alias("error"))
    filled = [c for c in stats.columns if c != "source_id"]
    return blocked.join(stats, "source_id", "left").select(
        "source_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in filled],
        "error")


def batch_report(report: DataFrame) -> DataFrame:
    return batch_statistics(report)
