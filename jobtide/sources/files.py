"""Master lists, snapshots and exports read back from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators.keyed import keep_last
from .sinks import CSV

LEGACY = ["short_description", "scrape_date"]


def decode_master(raw: DataFrame) -> DataFrame:
    """Typed master-list rows of text columns; columns an older list lacks get defaults."""
    def field(name: str) -> Column:
        return F.col(name) if name in raw.columns else F.lit(None).cast("string")

    def known(name: str, values: list[str]) -> Column:
        text = F.upper(F.trim(field(name)))
        return F.when(text.isin(values), text).otherwise("UNKNOWN")

    posted = F.to_timestamp(field("date"), "yyyy-MM-dd")
    return raw.select(
        known("status", fixed.MASTER_STATUSES).alias("status"), field("title").alias("title"),
        field("company").alias("company"), field("location").alias("location"), posted.alias("post_date"),
        F.coalesce(F.try_to_timestamp(field("scrape_date"), F.lit("yyyy-MM-dd")), posted).alias("scrape_date"),
        field("blurb").alias("description"), F.split(field("tags"), ",").alias("tags"), field("link").alias("url"),
        field("id").alias("key_id"), field("provider").alias("provider"), field("query").alias("query"),
        known("locale", fixed.MASTER_LOCALES).alias("locale"),
        F.coalesce(F.trim(field("wage")), F.lit("")).alias("wage"),
        known("remoteness", fixed.MASTER_REMOTENESS).alias("remoteness"),
        F.coalesce(field("short_description"), F.lit("")).alias("short_description"))


def read_master_csv(spark: SparkSession, path: str, legacy: bool = False) -> DataFrame:
    """Master list from CSV. `legacy` files carry the two extra columns at their end."""
    columns = fixed.MASTER_COLUMNS + (LEGACY if legacy else [])
    schema = ", ".join(f"`{c}` string" for c in columns)
    raw = spark.read.csv(path, schema=schema, multiLine=True, enforceSchema=False, **CSV)
    return decode_master(raw)


def recover(spark: SparkSession, path: str, key: str = "key_id", schema: str | None = None) -> DataFrame:
    """Master list rebuilt from daily snapshots; the later file wins per key."""
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.parquet(path)
    return keep_last(rows.withColumn("_file", F.col("_metadata.file_path")), [key], ["_file"]).drop("_file")


EXPORT_SCHEMA = """id long, title string, company string, location string, url string, job_type string,
experience_level string, remote_type string, salary_min int, salary_max int, salary_currency string,
first_seen_at timestamp, last_seen_at timestamp, is_active boolean, external_id string, content_hash string,
source_name string, source_type string, compliance_status string"""


def read_export_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EXPORT_SCHEMA).json(path)


def read_export_json(spark: SparkSession, path: str) -> DataFrame:
    """Jobs of single-document exports; one document is one small task."""
    fields = EXPORT_SCHEMA.replace("\n", " ")
    jobs = ",".join(f"{p.split()[0]}:{p.split()[1]}" for p in fields.split(","))
    wrapped = spark.read.schema(f"jobs array<struct<{jobs}>>").option("multiLine", True).json(path)
    return wrapped.select(F.inline("jobs"))
