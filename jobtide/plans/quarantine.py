"""Landed records of many sources: the unreadable ones are set aside and show as an error of their source alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUIRED = ("title", "company", "url")


def read_landed(landed: DataFrame, schema: str, required: Sequence[str] = REQUIRED, payload: str = "payload") -> DataFrame:
    """Every landed record with its fields and an `unreadable` reason, null for a good one.

    A record is a JSON object in `payload`, beside the columns that say where it came from. Empty and broken texts, values of a wrong
    type and missing required fields are reasons; no record is lost and none stops the others.
    """
    fields = T.StructType.fromDDL(schema)
    wide = T.StructType([*fields, T.StructField("_broken", T.StringType())])
    parsed = F.from_json(F.col(payload), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    rows = landed.withColumn("_record", parsed)
    record = F.col("_record")
    missing = F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(F.trim(record[c].cast("string")), F.lit("")) == "", F.lit(c)) for c in required])), ", ")
    reason = (F.when(F.trim(F.coalesce(F.col(payload), F.lit(""))) == "", "Empty record")
              .when(record.isNull() | record["_broken"].isNotNull(), "Unreadable record")
              .when(missing != "", F.concat(F.lit("Missing "), missing)))
    return rows.select(*landed.columns, *[record[f.name].alias(f.name) for f in fields if f.name not in landed.columns], reason.alias("unreadable"))


def set_aside(records: DataFrame, columns: Sequence[str], payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """The good records, and the quarantine table of the others: where they came from, the text as it landed, and why."""
    good = records.filter("unreadable is null").drop(payload, "unreadable")
    return good, records.filter("unreadable is not null").select(*columns, payload, F.col("unreadable").alias("reason"))


def with_unreadable(report: DataFrame, quarantined: DataFrame) -> DataFrame:
    """A run report with the unreadable records of each source; a source with some shows them as its error if it has no other."""
    counts = quarantined.groupBy("source_id").agg(F.count("*").alias("unreadable"), F.min("reason").alias("_why"))
    rows = report.join(counts, "source_id", "full")
    filled = [c for c in report.columns if c not in ("source_id", "error")]
    note = F.concat(F.col("unreadable").cast("string"), F.lit(" unreadable: "), F.col("_why"))
    return rows.select("source_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in filled], F.coalesce("unreadable", F.lit(0)).cast("long").alias("unreadable"),
                       F.coalesce("error", note).alias("error"))
