"""Writers and the rows they write."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import block_list_text
from ..operators.quality import valid_master_rows

CSV = dict(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
ISO = "yyyy-MM-dd'T'HH:mm:ss"


def iso_times(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text."""
    return df.select(*[
        F.date_format(c, ISO).alias(c) if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes])


def csv_rows(rows: DataFrame, include_source: bool = True, include_description: bool = False) -> DataFrame:
    """Export rows in the fixed column order of the CSV form."""
    columns = list(fixed.EXPORT_COLUMNS)
    if include_source:
        columns += fixed.EXPORT_SOURCE_COLUMNS
    if include_description:
        columns.append("description")
    return iso_times(rows.select(*columns))


def export_csv(rows: DataFrame, path: str, **options) -> None:
    csv_rows(rows, **options).write.mode("errorifexists").csv(path, **CSV)


def export_metadata(rows: DataFrame, filters: dict, exported_at: datetime) -> DataFrame:
    """One row that describes an export."""
    described = F.to_json(F.create_map(*[
        F.lit(x) for k, v in sorted(filters.items()) for x in (k, None if v is None else str(v))]))
    return rows.agg(F.count("*").alias("job_count")).select(
        F.date_format(F.lit(exported_at), ISO).alias("exported_at"), "job_count", described.alias("filters"))


def export_json(rows: DataFrame, path: str, filters: dict, exported_at: datetime) -> None:
    """Jobs as JSON lines and a metadata file beside them."""
    iso_times(rows).write.mode("errorifexists").json(f"{path}/jobs")
    export_metadata(rows, filters, exported_at).write.mode("errorifexists").json(f"{path}/metadata")


def export_jsonl(rows: DataFrame, path: str) -> None:
    iso_times(rows).write.mode("errorifexists").json(path)


def master_rows(rows: DataFrame) -> DataFrame:
    """Valid master rows in the fixed column order of the list."""
    good = valid_master_rows(rows)
    return good.select(
        "status", "title", "company", "location", F.date_format("post_date", "yyyy-MM-dd").alias("date"),
        F.col("description").alias("blurb"), F.array_join("tags", "\n").alias("tags"), F.col("url").alias("link"),
        F.col("key_id").alias("id"), "provider", "query", "locale", "wage", "remoteness")


def write_master_csv(rows: DataFrame, path: str) -> None:
    master_rows(rows).write.mode("errorifexists").csv(path, **CSV)


def block_list_rows(rows: DataFrame) -> DataFrame:
    """Entries of block and duplicate lists; long descriptions are cut."""
    return rows.select("key_id", "title", "company", F.date_format("post_date", "yyyy-MM-dd").alias("post_date"),
                       block_list_text("description").alias("description"), "status")


def write_block_list(rows: DataFrame, path: str) -> None:
    block_list_rows(rows).write.mode("errorifexists").json(path)


def sitemap_rows(companies: DataFrame, vacancies: DataFrame, host: str, section: str) -> DataFrame:
    """Address and last change of every company page."""
    latest = vacancies.groupBy("alias").agg(F.max("date").alias("_last"))
    return companies.join(latest, "alias", "left").select(
        F.concat(F.lit(f"https://{host}/{section}/companies/"), "alias").alias("loc"),
        F.coalesce(F.date_format("_last", "yyyy-MM-dd"), F.lit("2025-01-01")).alias("lastmod"))


def alert_rows(fresh: DataFrame, board: str, other: str) -> DataFrame:
    """Message text and route of each newly seen posting.

    Keys that name `board` take its route, all others the one of `other`.
    """
    kind = F.when(F.col("is_internship"), "Internship").otherwise("Job")
    line = lambda label, c: F.concat(F.lit(f"\n  {label}: "), c)
    text = F.concat(
        F.lit("New "), kind, F.lit(" at "), F.col("company"), F.lit(":"), line("Job Title", F.col("job_title")),
        line("Location", F.col("location")), line("Link", F.col("url")), line("Found At", F.col("found_at")),
        line("Posted At", F.col("posted_time")),
        line("Apply Clicks", F.coalesce(F.col("apply_clicks"), F.lit("N/A"))))
    feed = F.when(F.col("key").contains(board), board).otherwise(other)
    return fresh.select("key", text.alias("message"), route(feed, F.col("is_internship")).alias("route"))


def route(board: Column, internship: Column) -> Column:
    return F.concat(board, F.when(internship, "_internships").otherwise("_jobs"))


def write_alerts(fresh: DataFrame, path: str, board: str, other: str) -> None:
    alert_rows(fresh, board, other).write.mode("append").partitionBy("route").json(path)
