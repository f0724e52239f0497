"""Master list update: block, filter, match, refresh, append."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators.filters import job_filter
from ..operators.keyed import keep_first
from ..operators.lifecycle import grow_block_list, update_if_newer
from ..operators.similarity import match_incoming


def update_master(master: DataFrame, scraped: DataFrame, block_list: DataFrame, known: DataFrame, *,
               oldest: datetime | None = None, blocked_companies: tuple[str, ...] = (),
               remoteness: str = "ANY", threshold: float = 0.75) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Next master list, the match table, and the grown block list.

    Both tables need id, key_id, status, title, company, description, post_date
    and remoteness; `id` gives the order of arrival.
    """
    blocked = grow_block_list(block_list, master, fixed.MASTER_REMOVE_STATUSES)
    options = dict(blocked_companies=blocked_companies, oldest=oldest, block_list=blocked, remoteness=remoteness)
    kept = job_filter(master, **options)
    fresh = job_filter(keep_first(scraped, ["key_id"], ["id"]), **options)
    matches = match_incoming(kept, fresh, known, threshold=threshold)
    refreshed = update_if_newer(kept, matches, fresh)
    added = fresh.join(matches.select(F.col("duplicate_id").alias("id")), "id", "left_anti")
    return refreshed.unionByName(added.withColumn("updated", F.lit(False))), matches, blocked
