"""Keyed reductions: first, last and best rows, ids, and change detection.

The first row per key is a row number of one, which Spark cuts before the shuffle as well as after it
(a window group limit), so a key that holds a large share of the rows reaches its reducer as one row of each task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in columns])


def _keep(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in `order`; a missing value comes first."""
    return _keep(df, keys, [F.col(c).asc() for c in order])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in `order`; a missing value comes first."""
    return _keep(df, keys, [F.col(c).desc() for c in order])


def best_match(scores: DataFrame, query: str, candidate: str, score: str) -> DataFrame:
    """Highest-scoring candidate per query row, the smallest candidate on ties."""
    rank = F.struct((-F.col(score)).alias("s"), F.col(candidate).alias("c"))
    return scores.groupBy(query).agg(F.min(rank).alias("_b")).select(
        query, F.col("_b.c").alias(candidate), (-F.col("_b.s")).alias(score))


def newest_first(df: DataFrame, date: str, key: str = "id") -> DataFrame:
    """Newest first, rows without a date last, larger key first on ties."""
    return df.orderBy(F.col(date).desc_nulls_last(), F.col(key).desc())


def pinned_first(df: DataFrame, pinned: Column, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(F.coalesce(pinned, F.lit(False)).desc(), *order)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    """One page of an ordered result."""
    return df.orderBy(*order).offset(offset).limit(limit)


def page_after(df: DataFrame, date: str, key: str, after: tuple, limit: int) -> DataFrame:
    """The page after a known row, newest first, without counting skipped rows."""
    day, last = F.lit(after[0]), F.lit(after[1])
    later = (F.col(date) < day) | ((F.col(date) == day) & (F.col(key) < last))
    return df.filter(later).orderBy(F.col(date).desc(), F.col(key).desc()).limit(limit)


NO_RANGE = 2**63 - 1  # the range of rows without a value: after all others


def _sizes_before(sizes: DataFrame, width: int, levels: int) -> DataFrame:
    """For each `_range` the sum of `_n` over all smaller ranges."""
    order = F.col("_range").asc_nulls_last()
    if not levels:
        before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    wide = sizes.withColumn("_wide", F.floor(F.col("_range") / width))
    above = _sizes_before(wide.groupBy(F.col("_wide").alias("_range")).agg(F.sum("_n").alias("_n")), width, levels - 1)
    above = above.select(F.col("_range").alias("_upper"), F.col("_before").alias("_start"))
    inside = Window.partitionBy("_wide").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summed = wide.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return (summed.join(above, F.col("_wide").eqNullSafe(F.col("_upper")))
            .select("_range", (F.col("_start") + F.col("_inside")).alias("_before")))


def numbered(df: DataFrame, order: str, start: Column, out: str, width: int = 100_000) -> DataFrame:
    """Consecutive numbers from `start + 1`, in the order of a unique whole-number column; rows without a value come last.

    Rows are numbered inside ranges of `width` order values, and each range starts
    after the sizes of the ranges before it. The sizes are summed inside wider ranges
    and those inside still wider ones, so that sparse 64-bit values leave some
    thousand sums for the last step, whatever the number of rows.
    """
    # Plain equality of ranges that are never null: the rows stay where the window put them when the offsets join.
    ranged = df.withColumn("_range", F.coalesce(F.floor(F.col(order) / width), F.lit(NO_RANGE)))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    offsets = _sizes_before(sizes, width, 2).withColumnRenamed("_range", "_offset_range")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    return (
        ranged.withColumn("_inside", inside).join(offsets, F.col("_range") == F.col("_offset_range"))
        .withColumn(out, start + F.col("_before") + F.col("_inside"))
        .drop("_range", "_offset_range", "_before", "_inside")
    )


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                  bucket: str, out: str = "previous") -> DataFrame:
    """Add the value of the row before, per key.

    `bucket` is a column that never decreases along `order` (a day, say). Rows are
    ordered per key and bucket; the last value of each bucket is handed to the
    next one, so no key is sorted in one task. Rows without a time come first, and
    rows without a key form a group of their own; none is lost.
    """
    last = df.groupBy(*keys, bucket).agg(F.max_by(F.struct(value), _order(order)).alias("_last"))
    places = [*keys, bucket]
    carried = last.select(*[F.col(c).alias(f"_at_{c}") for c in places], F.lag("_last").over(
        Window.partitionBy(*keys).orderBy(bucket)).alias("_carry"))
    inside = F.lag(F.struct(value)).over(Window.partitionBy(*keys, bucket).orderBy(*order))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in places])
    return (
        df.withColumn("_inside", inside).join(carried, same)
        .withColumn(out, F.coalesce("_inside", "_carry")[value])
        .drop("_inside", "_carry", *[f"_at_{c}" for c in places])
    )
