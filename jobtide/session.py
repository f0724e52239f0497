"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


SMALL_PART = 128 << 20  # bytes that one core reads by itself


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session that already exists."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("jobtide")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    A session in one local process (as in tests) may go without; a cluster must name a folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not _local(spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="jobtide-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def shared(df: DataFrame) -> DataFrame:
    """Share the rows of a small table among the cores before costly row rules.

    A table that is read in fewer parts than the session has cores would leave the others idle; any larger one is read as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores and _bytes_read(df) < cores * SMALL_PART else df


def _bytes_read(df: DataFrame) -> int:
    """Spark's own estimate of a table's size, from its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def hashed(df: DataFrame) -> DataFrame:
    """The narrow side of a join, with one row per key: hashed where it is too large to be broadcast, so that the rows it meets are not sorted."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df.hint("shuffle_hash") if _bytes_read(df) > limit else df


def kept(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table that several steps read, and read it back.

    The steps then neither repeat its work nor depend on the executors that did it.
    """
    return _written(df, name, compression)


def kept_blocks(df: DataFrame, name: str) -> DataFrame:
    """As `kept`, for rows of megabytes each: a row group holds one row.

    Spark's Parquet reader unpacks up to some thousand rows of a row group at once, which may be all rows of a file.
    """
    return _written(df, name, None, **{"parquet.block.row.count.limit": "1"})


def _written(df: DataFrame, name: str, compression: str | None, **options: str) -> DataFrame:
    path = work_path(df.sparkSession, name)
    df.write.options(**options).parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)
