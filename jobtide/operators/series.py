"""Daily series without gaps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .aggregate import favorite_totals, view_totals


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range((end - start).days + 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))


def fill_days(counts: DataFrame, start: date, end: date, value: str,
              keys: Sequence[str] = ()) -> DataFrame:
    """Every day of a range, zero where nothing was counted.

    With keys, each key that occurs at all gets its own full range.
    """
    if keys:
        days = counts.select(*keys).distinct().withColumn(
            "day", F.explode(F.sequence(F.lit(start), F.lit(end))))
    else:
        days = calendar(counts.sparkSession, start, end)
    return days.join(counts, [*keys, "day"], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def daily_series(events: DataFrame, start: date, end: date, *, ts: str = "ts",
                 keys: Sequence[str] = (), user: str | None = None, out: str = "count") -> DataFrame:
    """Events, or different users with `user`, per day of a range."""
    inside = events.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end + timedelta(days=1))))
    day = F.to_date(ts).alias("day")
    if user:
        seen = inside.groupBy(*keys, day, user).agg(F.lit(1).alias("one"))
        counts = seen.groupBy(*keys, "day").agg(F.count("*").alias(out))
    else:
        counts = inside.groupBy(*keys, day).agg(F.count("*").alias(out))
    return fill_days(counts, start, end, out, keys)


def month_dashboard(subscriptions: DataFrame, views: DataFrame, day: date, key: str) -> DataFrame:
    """Daily series of the last month and totals, for subscribers and views, per entity."""
    start = _month_before(day)

    def block(events: DataFrame, name: str) -> DataFrame:
        daily = daily_series(events, start, day, keys=[key])
        totals = events.groupBy(key).agg(F.count("*").alias("total_count"))
        return daily.join(totals, key).select(F.lit(name).alias("series"), key, "day", "count", "total_count")

    return block(subscriptions, "subscribers").unionByName(block(views, "views"))


def _month_before(day: date) -> date:
    year, month = (day.year, day.month - 1) if day.month > 1 else (day.year - 1, 12)
    # Days past the end of the shorter month run over into the next one.
    return date(year, month, 1) + timedelta(days=day.day - 1)


def company_dashboard(views: DataFrame, favorites: DataFrame, since: datetime, key: str) -> DataFrame:
    """Views and favourites per entity, in all and since a day."""
    v = view_totals(views, since, key).withColumnsRenamed({"total": "total_views", "since": "month_views"})
    f = favorite_totals(favorites, since, key).withColumnsRenamed(
        {"total": "total_favorites", "since": "month_favorites"})
    both = v.join(f, key, "full")
    return both.select(key, *[F.coalesce(c, F.lit(0)).alias(c) for c in
                              ("total_views", "month_views", "total_favorites", "month_favorites")])
