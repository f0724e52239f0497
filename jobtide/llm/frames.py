"""Small helpers for tables that are passed through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def numbered(docs: DataFrame, *named: str) -> DataFrame:
    """The table with its columns called _c0, _c1, ... except the named ones, so that no name can clash."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in named else f"_c{i}") for i, c in enumerate(docs.columns)])


def restored(docs: DataFrame, columns: list[str], *named: str) -> DataFrame:
    """The columns under their first names again."""
    return docs.select(*[F.col(c) if c in named else F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)])
