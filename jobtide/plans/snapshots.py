"""Versioned snapshots: the next one is written beside the old, then made current by a small note."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import versions


class SnapshotTable:
    """A table at a folder that is replaced as a whole; readers of the version before go on undisturbed."""

    def __init__(self, spark: SparkSession, folder: str, keep: int = 2) -> None:
        self.spark, self.folder, self.keep = spark, folder, keep

    def now(self) -> DataFrame | None:
        """The current snapshot, or nothing if none was published."""
        note = versions.current(self.spark, self.folder)
        return None if note is None else self.spark.read.parquet(f"{self.folder}/{note['path']}")

    def version(self) -> int:
        note = versions.current(self.spark, self.folder)
        return 0 if note is None else note["version"]

    def replace(self, snapshot: DataFrame) -> DataFrame:
        """Write the next snapshot, make it current and drop the versions before the last `keep`; returns it.

        The next snapshot may read the current one, as lifecycle operators do. A writer that is lost half way leaves the old one current.
        """
        path = f"snapshots/{self.version() + 1}"
        # Hashes in hex take half the room in zstd.
        snapshot.write.mode("overwrite").parquet(f"{self.folder}/{path}", compression="zstd")
        versions.publish(self.spark, self.folder, {"path": path})
        versions.clean(self.spark, self.folder, lambda note: [note["path"]], self.keep)
        return self.now()
