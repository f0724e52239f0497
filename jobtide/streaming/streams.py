"""The ingestion loop, the counters and the toggles as Structured Streaming jobs.

Results go to Parquet under the caller's folder. A micro-batch writes into its own
directory and overwrites it when it is run again after a failure, so a lost
executor or driver never counts anything twice. A stream that starts from a new
checkpoint numbers its batches after those that are there. What a stream has to remember for ever is a
`StoredState`: each batch reads the keys it touches and a bounded tail.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import match_keys, new_postings
from ..operators.keyed import keep_first, with_previous
from ..plans import ingest
from .state import StoredState

BatchStep = Callable[[DataFrame, int], None]


def table_stream(spark: SparkSession, folder: str, schema: str, files: str = "*.parquet",
                 per_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream, oldest file first."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", files)
            .option("maxFilesPerTrigger", per_batch).parquet(folder))


def drain(stream: DataFrame, step: BatchStep, checkpoint: str, mode: str = "update") -> None:
    """Process everything that has arrived, then stop. Operators' state is kept off the heap."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    query = (stream.writeStream.outputMode(mode).foreachBatch(step)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored table, or nothing if none was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def batch_number(spark: SparkSession, path: str, batch_id: int, last: Callable[[], int] | None = None) -> int:
    """The number under which a micro-batch is stored: the same if it is run again, and after all batches of earlier checkpoints.

    A stream keeps its query id as long as it keeps its checkpoint; the first number of each is noted beside the batches. `last`
    gives the number of the last stored batch, where the folder's batch directories do not tell it.
    """
    note = f"{path}/_runs/{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}"
    start = _stored(spark, note)
    if start is None:
        if last is None:
            log = _stored(spark, path)
            first = 0 if log is None else (log.agg(F.max("batch")).first()[0] or 0) + 1
        else:
            first = last() + 1
        spark.range(first, first + 1, 1, 1).write.mode("overwrite").parquet(note)
        start = spark.read.parquet(note)
    return start.first()[0] + batch_id


def append_to(path: str) -> BatchStep:
    """Write each micro-batch into its own directory."""
    def step(batch: DataFrame, batch_id: int) -> None:
        number = batch_number(batch.sparkSession, path, batch_id)
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return step


def drain_to(stream: DataFrame, path: str, checkpoint: str, mode: str) -> DataFrame:
    """Run a stream into a folder of batch directories and read it back."""
    drain(stream, append_to(path), checkpoint, mode)
    return stream.sparkSession.read.parquet(path)


def latest(table: DataFrame, keys: Sequence[str], batch: str = "batch") -> DataFrame:
    """Last version of each row of an update-mode table."""
    rest = [c for c in table.columns if c not in (*keys, batch)]
    row = F.max_by(F.struct(*rest), batch).alias("_r")
    return table.groupBy(*keys).agg(row).select(*keys, "_r.*")


def latest_state(spark: SparkSession, folder: str, keys: Sequence[str], columns: str, **options: int) -> StoredState:
    """State that keeps the last version of each row; `columns` are the keys and the others, without the batch."""
    def fold(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in (*keys, "batch")]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r"), F.max("batch").alias("batch")).select(*keys, "_r.*", "batch")

    return StoredState(spark, folder, keys, f"{columns}, batch long", fold, **options)


def drain_to_state(stream: DataFrame, state: StoredState, checkpoint: str, mode: str = "update") -> DataFrame:
    """Run an update-mode stream into stored state and read what is current; the log of updates is folded as it grows."""
    def step(batch: DataFrame, batch_id: int) -> None:
        number = batch_number(batch.sparkSession, state.folder, batch_id, state.last)
        state.add(batch.withColumn("batch", F.lit(number).cast("long")), number)

    drain(stream, step, checkpoint, mode)
    return state.now().drop("batch")


def posting_state(spark: SparkSession, folder: str, columns: str, key: str = "content_hash", **options: int) -> StoredState:
    """One row per key: its first full row, when it was first and last seen, and in how many batches.

    `columns` are those of the canonical rows without the key and the time.
    """
    def fold(rows: DataFrame) -> DataFrame:
        spans = ("first_seen_at", "last_seen_at", "sightings", "batch")
        rest = [c for c in rows.columns if c not in (key, *spans)]
        return rows.groupBy(key).agg(
            F.min_by(F.struct(*rest), "batch").alias("_r"), F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"),
            F.sum("sightings").alias("sightings"), F.min("batch").alias("batch")).select(key, "_r.*", *spans)

    return StoredState(spark, folder, [key], f"{key} string, {columns}, first_seen_at timestamp, last_seen_at timestamp, sightings long, batch long", fold, **options)


def sightings(rows: DataFrame, number: int, seen: str = "seen_at") -> DataFrame:
    """Canonical rows of a batch as changes of a posting state."""
    time = F.col(seen).cast("timestamp")
    return rows.withColumns({"first_seen_at": time, "last_seen_at": time, "sightings": F.lit(1).cast("long"), "batch": F.lit(number).cast("long")}).drop(seen)


def ingest_stream(raw: DataFrame, state: StoredState, checkpoint: str, canonical: Callable[[DataFrame], DataFrame],
                  order: str = "seq") -> None:
    """Landed batches to canonical rows, one row per key, folded into a posting state."""
    def step(batch: DataFrame, batch_id: int) -> None:
        number = batch_number(batch.sparkSession, state.folder, batch_id, state.last)
        state.add(sightings(keep_first(canonical(batch), state.keys, [order]), number), number)

    drain(raw, step, checkpoint, "append")


def key_state(spark: SparkSession, folder: str, **options: int) -> StoredState:
    """The owner of each match key: the posting that was taken in last."""
    def fold(rows: DataFrame) -> DataFrame:
        return rows.groupBy("rank", "kind", "key").agg(F.max("original_id").alias("original_id"))

    return StoredState(spark, folder, ["rank", "kind", "key"], "rank int, kind string, key string, original_id long", fold, **options)


def job_stream(raw: DataFrame, sources: DataFrame, postings: StoredState, keys: StoredState, outcomes: str, checkpoint: str, seen: Column) -> None:
    """The whole ingestion loop as a stream: gate, match by hash, id and URL, normalise, classify, insert or touch.

    `postings` and `keys` hold what was taken in so far; a batch reads the match keys that it has itself. Every raw row is
    noted with its outcome under `outcomes`. Postings are stored before the keys: a batch that is run again sees the keys as they were
    before it, until it is done.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        number = batch_number(spark, outcomes, batch_id, keys.last)
        if keys.holds(number):
            return
        rows = ingest.gated(batch, sources)
        asked = ingest.asked_keys(rows)
        done = ingest.finished(rows, ingest.matches_of(asked, keys.of(asked, before=number)))
        done.write.mode("overwrite").parquet(f"{outcomes}/batch={number}")
        done = spark.read.parquet(f"{outcomes}/batch={number}")
        accepted = done.filter("outcome = 'accepted'").withColumn("id", F.col("seq"))
        first = keep_first(accepted, postings.keys, ["seq"]).withColumn("seen_at", seen)
        postings.add(sightings(first, number), number)
        keys.add(match_keys(accepted, "id").withColumnRenamed("id", "original_id"), number)

    drain(raw, step, checkpoint, "append")


def new_posting_stream(postings: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Each key once; the state of a key is dropped once it is older than `delay`."""
    return postings.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def seen_state(spark: SparkSession, folder: str, key: str = "key", kind: str = "string", **options: int) -> StoredState:
    """All keys that were ever seen."""
    return StoredState(spark, folder, [key], f"{key} {kind}", lambda rows: rows.select(key).distinct(), **options)


def alert_step(seen: StoredState, alerts_path: str, url: str = "url", order: str = "seq") -> BatchStep:
    """Exact form of the alert stream: the keys of a batch are looked up among all keys ever seen."""
    (key,) = seen.keys

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        number = batch_number(spark, alerts_path, batch_id, seen.last)
        if seen.holds(number):
            return
        fresh = new_postings(batch, seen.of(batch, before=number), key, url, order)
        fresh.write.mode("overwrite").parquet(f"{alerts_path}/batch={number}")
        seen.add(spark.read.parquet(f"{alerts_path}/batch={number}"), number)

    return step


def view_counter_stream(events: DataFrame, key: str, delay: str, ts: str = "ts") -> DataFrame:
    """Views per entity and day, in update mode; rows later than `delay` do not count."""
    return (events.withWatermark(ts, delay).groupBy(F.window(ts, "1 day").alias("w"), key)
            .agg(F.count("*").alias("views")).select(key, F.to_date("w.start").alias("day"), "views"))


def unique_viewer_stream(events: DataFrame, key: str, delay: str, user: str = "user_id",
                         ts: str = "ts") -> DataFrame:
    """Each viewer once per entity and day, in append mode: by the hour, then by the day; rows later than `delay` do not count."""
    hours = (events.withColumn("hour", F.date_trunc("hour", ts)).withWatermark("hour", delay)
             .dropDuplicates([key, "hour", user]))
    return (hours.withColumn("day", F.to_date("hour"))
            .dropDuplicatesWithinWatermark([key, "day", user]).select(key, "day", user, "hour"))


def daily_viewer_stream(events: DataFrame, key: str, delay: str, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Distinct viewers per entity and day, in append mode: viewers once by the hour and once by the day, then counted.

    Three stateful operators follow each other; a day is emitted once the watermark has passed it.
    """
    first = unique_viewer_stream(events, key, delay, user, ts)
    return first.groupBy(F.window("hour", "1 day").alias("w"), key).agg(F.count("*").alias("viewers")).select(key, F.to_date("w.start").alias("day"), "viewers")


def online_stream(events: DataFrame, delay: str, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Last sight of each user per hour, in update mode; the last write wins, rows later than `delay` do not count."""
    return (events.withWatermark(ts, delay).groupBy(F.window(ts, "1 hour").alias("w"), user)
            .agg(F.max(ts).alias("last_seen")).select(user, F.col("w.start").alias("hour"), "last_seen"))


def minute_flush_stream(events: DataFrame, delay: str, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Last sight of each user in each minute, handed out once the minute is over, in append mode.

    The last write wins. A user's open minutes are keyed state, which the watermark hands out and forgets; rows whose minute was handed out
    do not count. Sights of a minute are reduced before the shuffle, and state is read and written once per key and batch.
    """
    seen = events.select(F.col(user).cast("long").alias("user_id"), F.col(ts).cast("timestamp").alias("ts"))
    minutes = seen.withWatermark("ts", delay).groupBy(F.window("ts", "1 minute").alias("w"), "user_id").agg(F.max("ts").alias("last_seen"))
    return minutes.select("user_id", F.col("w.start").alias("minute"), "last_seen")


def toggle_state(spark: SparkSession, folder: str, keys: Sequence[str], columns: str, ts: str = "ts", value: str = "active",
                 tie: str = "event_id", **options: int) -> StoredState:
    """The last change of each switch; `columns` are the keys, the time, the tie and the value."""
    def fold(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.max_by(F.struct(ts, tie, value, "batch"), F.struct("batch", ts, tie)).alias("_r")).select(*keys, "_r.*")

    return StoredState(spark, folder, keys, f"{columns}, batch long", fold, **options)


def toggle_step(path: str, state: StoredState, ts: str = "ts", value: str = "active", tie: str = "event_id") -> BatchStep:
    """On/off events that really change a switch, with +1 or -1, as a change log.

    A batch looks up the last change of its own keys. Within it rows are compared per key and hour, so a busy key is spread over
    tasks.
    """
    keys = state.keys

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        number = batch_number(spark, path, batch_id, state.last)
        if state.holds(number):
            return
        rows = batch.withColumn("_hour", F.date_trunc("hour", ts))
        marked = with_previous(rows, keys, [ts, tie], value, "_hour", "_before").drop("_hour")
        before = state.of(batch, before=number).select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col(value).alias("_state"))
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
        marked = marked.join(before, same, "left").withColumn("_before", F.coalesce("_before", "_state"))
        changed = F.col("_before").isNull() | (F.col("_before") != F.col(value))
        out = marked.filter(changed).withColumn("diff", F.when(F.col(value), 1).otherwise(-1))
        out.select(*keys, ts, tie, value, "diff").write.mode("overwrite").parquet(f"{path}/batch={number}")
        done = spark.read.parquet(f"{path}/batch={number}").withColumn("batch", F.lit(number).cast("long"))
        state.add(state.fold(done), number)

    return step
