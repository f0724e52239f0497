"""Export: filter, order, format."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.filters import export_order, export_select
from ..sources.sinks import csv_rows, iso_times


def export_rows(jobs: DataFrame, sources: DataFrame, form: str = "csv", limit: int | None = None,
                **filters) -> DataFrame:
    """Rows of an export in their final order and form (`csv` or `json`)."""
    rows = export_order(export_select(jobs, sources, **filters))
    if limit:
        rows = rows.limit(limit)
    return csv_rows(rows) if form == "csv" else iso_times(rows)
