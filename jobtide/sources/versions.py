"""Versions of stored tables: data is written beside the old, and one small note makes it current.

A reader takes the newest note and the paths it names, so it never sees half-written data. A writer that is lost before its note
changes nothing; the next one writes over what it left. One writer at a time is assumed.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _notes(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """All notes of a table, newest first; old ones go with `clean`."""
    try:
        notes = spark.read.schema("value string, v long").text(f"{folder}/versions")
        return [(r["v"], r["value"]) for r in notes.orderBy(F.desc("v")).collect()]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def current(spark: SparkSession, folder: str) -> dict | None:
    """The newest note with its number as `version`, or nothing if the table has none yet."""
    notes = _notes(spark, folder)
    return {**json.loads(notes[0][1]), "version": notes[0][0]} if notes else None


def publish(spark: SparkSession, folder: str, note: dict) -> int:
    """Make a note the current one; its number is the one after the newest."""
    notes = _notes(spark, folder)
    number = notes[0][0] + 1 if notes else 1
    text = json.dumps({k: v for k, v in note.items() if k != "version"}, sort_keys=True)
    spark.range(1).coalesce(1).select(F.lit(text).alias("value")).write.mode("overwrite").text(f"{folder}/versions/v={number}")
    return number


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def clean(spark: SparkSession, folder: str, paths_of, keep: int = 2) -> list[str]:
    """Drop all but the newest notes, and the paths that only dropped ones name; returns those paths.

    `paths_of` gives the paths of a note, relative to the folder. Readers that opened one of the kept versions go on undisturbed.
    """
    notes = _notes(spark, folder)
    held = {p for _, text in notes[:keep] for p in paths_of(json.loads(text))}
    gone = sorted({p for _, text in notes[keep:] for p in paths_of(json.loads(text))} - held)
    for number, _ in notes[keep:]:
        remove(spark, f"{folder}/versions/v={number}")
    for path in gone:
        remove(spark, f"{folder}/{path}")
    return gone
