"""Source registry: the source row of each (board type, company)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators.keyed import keep_first
from ..operators.lifecycle import with_new_ids


def source_url(scraper_type: str = "scraper_type", company: str = "company"):
    """Default address of a board for a company."""
    url = F.replace(F.lit(fixed.DEFAULT_BOARD_URL), F.lit("{company}"), F.col(company))
    for kind, template in fixed.BOARD_URLS.items():
        url = F.when(F.col(scraper_type) == kind,
                     F.replace(F.lit(template), F.lit("{company}"), F.col(company))).otherwise(url)
    return url


def register_sources(sources: DataFrame, wanted: DataFrame, order: str = "seq") -> DataFrame:
    """Registry with a row for every wanted (scraper_type, company).

    New rows start as conditional and active, with the board's default address.
    """
    named = wanted.withColumn("name", F.concat_ws("_", "company", "scraper_type"))
    fresh = keep_first(named, ["name"], [order]).join(sources.select("name"), "name", "left_anti")
    added = with_new_ids(fresh, sources, order).select(
        "id", "name", source_url().alias("base_url"), "scraper_type",
        F.lit("conditional").alias("compliance_status"), F.lit(True).alias("is_active"))
    return sources.select(*added.columns).unionByName(added)
