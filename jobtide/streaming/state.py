"""Stored state of a stream that grows for ever: a folded base and a bounded tail of micro-batches.

A micro-batch writes its changes into a directory of its own. Every so many batches the tail is folded into a new base beside
the old one, and a version note makes it current and says which batches it holds. A batch therefore reads the base's buckets of the keys
it touches and at most that many batch directories, however long the history is. A batch that is run again after a failure replaces its own
directory, or does nothing if the base holds it already.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import versions

Fold = Callable[[DataFrame], DataFrame]


class StoredState:
    """State rows by key, at a folder; `fold` makes one state row per key of a base and changes of the same columns.

    The columns of a change are those of the state. `fold` must give the same result in one step as in several.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], schema: str | T.StructType, fold: Fold, every: int = 10, buckets: int = 16) -> None:
        self.spark, self.folder, self.keys, self.fold, self.every, self.buckets = spark, folder, list(keys), fold, every, buckets
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _note(self) -> dict:
        return versions.current(self.spark, self.folder) or {"base": None, "through": -1, "tail": []}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _read(self, kind: str, numbers: Sequence[int]) -> DataFrame:
        paths = [f"{self.folder}/{kind}/{n}" for n in numbers]
        return self.spark.read.schema(T.StructType([*self.schema, T.StructField("_bucket", T.IntegerType())])).parquet(*paths)

    def _stored(self, note: dict) -> DataFrame | None:
        parts = [self._read("base", [note["base"]])] if note["base"] is not None else []
        parts += [self._read("changes", [n]) for n in note["tail"]]
        if not parts:
            return None
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows

    def holds(self, number: int) -> bool:
        """Whether the base holds a batch already, so that running it again must change nothing."""
        return number <= self._note()["through"]

    def last(self) -> int:
        """The number of the last batch taken in, or -1."""
        note = self._note()
        return max([note["through"], *note["tail"]])

    def now(self) -> DataFrame:
        """One row per key."""
        rows = self._stored(self._note())
        rows = self.spark.createDataFrame([], self.schema) if rows is None else rows.drop("_bucket")
        return self.fold(rows)

    def of(self, touched: DataFrame, before: int | None = None) -> DataFrame:
        """State rows of the keys of some rows; with `before`, as it was before that batch.

        The keys' buckets are found first (at most `buckets` numbers), so that only their files are read.
        """
        note = self._note()
        if before is not None:
            note = note | {"tail": [n for n in note["tail"] if n < before]}
        rows = self._stored(note)
        keys = touched.select(*self.keys).distinct()
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        wanted = [r[0] for r in keys.select(self._bucket().alias("_bucket")).distinct().collect()]
        rows = rows.filter(F.col("_bucket").isin(wanted)).drop("_bucket")
        asked = keys.select(*[F.col(k).alias(f"_of_{k}") for k in self.keys])
        same = None
        for k in self.keys:
            test = F.col(k).eqNullSafe(F.col(f"_of_{k}"))
            same = test if same is None else same & test
        return self.fold(rows.join(asked, same, "left_semi"))

    def add(self, changes: DataFrame, number: int) -> None:
        """Store a batch's changes; folds the tail once it is long enough."""
        if self.holds(number):
            return
        rows = changes.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]).withColumn("_bucket", self._bucket())
        rows.write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.folder}/changes/{number}")
        note = self._note()
        tail = sorted({*note["tail"], number})
        if len(tail) < self.every:
            if tail != note["tail"]:
                versions.publish(self.spark, self.folder, note | {"tail": tail})
            return
        self._compact(note | {"tail": tail})

    def _compact(self, note: dict) -> None:
        number = max(note["tail"])
        base = self.fold(self._stored(note).drop("_bucket")).select(*self.schema.names).withColumn("_bucket", self._bucket())
        base.hint("rebalance", "_bucket").sortWithinPartitions("_bucket", *self.keys).write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.folder}/base/{number}")
        versions.publish(self.spark, self.folder, {"base": number, "through": number, "tail": []})
        versions.clean(self.spark, self.folder, _paths, keep=2)


def _paths(note: dict) -> list[str]:
    return ([f"base/{note['base']}"] if note["base"] is not None else []) + [f"changes/{n}" for n in note["tail"]]
