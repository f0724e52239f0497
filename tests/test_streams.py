import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from jobtide.catalog import streams as catalog_streams
from jobtide.operators import aggregate, lifecycle
from jobtide.streaming import streams

SCHEMA = "event_id long, ts timestamp, user_id long, entity long, active boolean"


def land(spark, folder, files=4, per_file=60):
    """Events in several files, one micro-batch each, with late and repeated rows."""
    start = datetime(2024, 1, 1)
    data = [(i, start + timedelta(minutes=41 * (i if i % 7 else max(0, i - 20))), i * 13 % 5, i * 7 % 3, i * 11 % 4 < 2) for i in range(files * per_file)]
    for f in range(files):
        part = data[f * per_file:(f + 1) * per_file]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return spark.createDataFrame(data, SCHEMA)


def events(spark, folder):
    return streams.table_stream(spark, folder, SCHEMA, per_batch=1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_counters_equal_the_batch_result(spark, tmp_path):
    batch = land(spark, f"{tmp_path}/in")
    out = streams.drain_to(streams.view_counter_stream(events(spark, f"{tmp_path}/in"), "entity", delay="30 days"),
                           f"{tmp_path}/out", f"{tmp_path}/cp", "update")
    expected = aggregate.running_counters(batch, "entity").select("entity", "day", "views")
    assert rows(streams.latest(out, ["entity", "day"])) == rows(expected)


def test_unique_viewers_equal_the_batch_result(spark, tmp_path):
    batch = land(spark, f"{tmp_path}/in")
    out = streams.drain_to(streams.unique_viewer_stream(events(spark, f"{tmp_path}/in"), "entity", delay="30 days"),
                           f"{tmp_path}/out", f"{tmp_path}/cp", "append")
    got = out.groupBy("entity", "day").agg(F.count("*").alias("viewers"))
    assert rows(got) == rows(aggregate.unique_viewers(batch, "entity"))


def test_online_users_keep_the_last_sight(spark, tmp_path):
    batch = land(spark, f"{tmp_path}/in")
    out = streams.drain_to(streams.online_stream(events(spark, f"{tmp_path}/in"), delay="30 days"), f"{tmp_path}/out", f"{tmp_path}/cp", "update")
    expected = batch.groupBy("user_id", F.date_trunc("hour", "ts").alias("hour")).agg(F.max("ts").alias("last_seen"))
    assert rows(streams.latest(out, ["user_id", "hour"])) == rows(expected)


def test_days_are_counted_by_the_stream_itself(spark, tmp_path):
    batch = land(spark, f"{tmp_path}/in")
    spark.createDataFrame([(10_000, datetime(2030, 1, 1), None, None, True)], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    out = streams.drain_to(streams.daily_viewer_stream(events(spark, f"{tmp_path}/in"), "entity", delay="30 days"), f"{tmp_path}/out", f"{tmp_path}/cp", "append")
    got = out.filter("entity is not null").select("entity", "day", "viewers")
    assert rows(got) == rows(aggregate.unique_viewers(batch, "entity").select("entity", "day", "viewers"))


def test_minutes_are_flushed_once_they_are_over(spark, tmp_path):
    start, folder = datetime(2024, 1, 1), f"{tmp_path}/in"
    data = [(i, start + timedelta(seconds=25 * (i if i % 7 else max(0, i - 12))), i % 3, 0, True) for i in range(160)]
    flushed = lambda: streams.minute_flush_stream(events(spark, folder), "10 minutes")
    for f in range(4):
        spark.createDataFrame(data[f * 40:(f + 1) * 40], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        if f in (1, 3):  # the stream stops and goes on from its checkpoint
            out = streams.drain_to(flushed(), f"{tmp_path}/out", f"{tmp_path}/cp", "append")
            minutes = spark.createDataFrame(data[: (f + 1) * 40], SCHEMA).groupBy("user_id", F.date_trunc("minute", "ts").alias("minute")).agg(F.max("ts").alias("last_seen"))
            over = start + timedelta(seconds=25 * ((f + 1) * 40 - 1)) - timedelta(minutes=10)
            assert rows(out.select("user_id", "minute", "last_seen")) == rows(minutes.filter(F.col("minute") + F.expr("interval 1 minute") <= F.lit(over)))
    spark.createDataFrame([(999, datetime(2030, 1, 1), None, None, True), (1000, start, 0, 0, True)], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    spark.createDataFrame([(1001, start, 0, 0, True)], SCHEMA).coalesce(1).write.mode("append").parquet(folder)  # too late
    out = streams.drain_to(flushed(), f"{tmp_path}/out", f"{tmp_path}/cp", "append").filter("user_id is not null")
    minutes = spark.createDataFrame(data, SCHEMA).groupBy("user_id", F.date_trunc("minute", "ts").alias("minute")).agg(F.max("ts").alias("last_seen"))
    assert rows(out.select("user_id", "minute", "last_seen")) == rows(minutes)


def test_toggles_equal_the_batch_result(spark, tmp_path):
    start = datetime(2024, 1, 1)
    data = [(i, start + timedelta(minutes=i), i % 3, i % 2, i * 11 % 5 < 2) for i in range(200)]
    for f in range(4):
        spark.createDataFrame(data[f * 50:(f + 1) * 50], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    columns = "user_id long, entity long, ts timestamp, event_id long, active boolean"
    step = streams.toggle_step(f"{tmp_path}/out", streams.toggle_state(spark, f"{tmp_path}/state", ["user_id", "entity"], columns, every=2))
    streams.drain(events(spark, f"{tmp_path}/in"), step, f"{tmp_path}/cp", "append")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.select("batch").distinct().count() > 1
    state = lifecycle.switch_state(spark.createDataFrame(data, SCHEMA), ["user_id", "entity"])
    got = out.groupBy("user_id", "entity").agg(F.max_by("active", "ts").alias("active"), F.max("ts").alias("updated_at"))
    assert rows(got.select("user_id", "entity", "active", "updated_at")) == rows(state.select("user_id", "entity", "active", "updated_at"))


def canonical(batch):
    return batch.select(F.col("event_id").alias("seq"), F.concat_ws("-", "user_id", "entity").alias("content_hash"), F.col("ts").alias("seen_at"))


def test_ingest_state_and_replayed_batch(spark, tmp_path):
    land(spark, f"{tmp_path}/in")
    state = streams.posting_state(spark, f"{tmp_path}/state", "seq long", every=3)
    streams.ingest_stream(events(spark, f"{tmp_path}/in"), state, f"{tmp_path}/cp", canonical)
    found = {r["content_hash"]: (r["seq"], r["sightings"]) for r in state.now().collect()}
    assert len(found) == 15 and set(found.values()) == {(i, 4) for i in range(15)}
    # The same batch written again replaces itself.
    step = streams.append_to(f"{tmp_path}/again")
    small = spark.range(3)
    step(small, 0)
    step(small, 0)
    assert spark.read.parquet(f"{tmp_path}/again").count() == 3


def test_state_is_folded_and_reads_stay_bounded(spark, tmp_path):
    state = streams.latest_state(spark, str(tmp_path), ["k"], "k long, v long", every=3, buckets=4)
    change = lambda n: spark.range(20).filter(f"id % 7 <> {n % 7}").selectExpr("id as k", f"id * 100 + {n} as v", f"cast({n} as long) as batch")
    files = []
    for n in range(9):
        state.add(change(n), n)
        state.add(change(n), n)  # run again
        files.append(len(state.now().inputFiles()))
        assert state.last() == n
    assert max(files[6:]) <= max(files[3:6]) + 4  # as many files however long the history is
    expected = {k: max(k * 100 + n for n in range(9) if k % 7 != n % 7) for k in range(20)}
    assert {r["k"]: r["v"] for r in state.now().collect()} == expected
    touched = state.of(spark.createDataFrame([(3,), (3,), (99,)], "k long"))
    assert [tuple(r) for r in touched.collect()] == [(3, expected[3], 8)]
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*_bucket", plan)
    state.add(change(20), 4)  # a batch that the base holds changes nothing
    assert {r["k"]: r["v"] for r in state.now().collect()} == expected
    earlier = streams.latest_state(spark, f"{tmp_path}/b", ["k"], "k long, v long", every=9)
    for n in range(3):
        earlier.add(change(n), n)
    assert {r["v"] % 100 for r in earlier.of(change(0).select("k"), before=2).collect()} == {0, 1}
    # Notes and folders that no reader can name any more are gone.
    assert len(list((tmp_path / "versions").glob("v=*"))) <= 4 and len(list((tmp_path / "base").iterdir())) <= 2


def test_alerts_across_batches_are_new_once(spark, tmp_path):
    land(spark, f"{tmp_path}/in")
    seen = streams.seen_state(spark, f"{tmp_path}/seen", "entity", "long", every=2)
    step = streams.alert_step(seen, f"{tmp_path}/alerts", url="event_id", order="event_id")
    streams.drain(events(spark, f"{tmp_path}/in"), step, f"{tmp_path}/cp", "append")
    assert sorted(r.entity for r in spark.read.parquet(f"{tmp_path}/alerts").collect()) == [0, 1, 2]


def test_a_new_checkpoint_keeps_the_state(spark, tmp_path):
    state = streams.posting_state(spark, f"{tmp_path}/state", "seq long")
    for run, folder in enumerate(["a", "b"]):
        start = datetime(2024, 1, 1 + run)
        data = [(100 * run + i, start, i + run, 0, True) for i in range(4)]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/{folder}")
        streams.ingest_stream(events(spark, f"{tmp_path}/{folder}"), state, f"{tmp_path}/cp_{folder}", canonical)
    assert state.last() == 1
    found = {r["content_hash"]: (r["seq"], r["sightings"], r["first_seen_at"].day, r["last_seen_at"].day) for r in state.now().collect()}
    assert found == {"0-0": (0, 1, 1, 1), "1-0": (1, 2, 1, 2), "2-0": (2, 2, 1, 2), "3-0": (3, 2, 1, 2), "4-0": (103, 1, 2, 2)}


JOB = ("seq long, source_id long, external_id string, url string, title string, company string, location string, description string, experience_level string, "
       "job_type string, remote_type string, salary_min int, salary_max int, salary_currency string")


def test_job_stream_takes_every_posting_once(spark, tmp_path):
    """Hash, id within a source, and URL each hide a later posting, in the same batch or an earlier one; a batch that failed half way is made good."""
    titles = ["Data Engineer", "QA Analyst", "Intern", "Staff Engineer", "Recruiter"]
    data = [(i, i * 7 % 4, f"x{i * 5 % 23}", f"https://b.example/{i * 11 % 29}", titles[i % 5], f"Company {i * 3 % 8}", "Berlin", None, None, None, None, None, None, None) for i in range(120)]
    for f in range(6):
        spark.createDataFrame(data[f * 20:(f + 1) * 20], JOB).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    sources = spark.createDataFrame([(0, "a", "approved", True), (1, "b", "conditional", True), (2, "c", "prohibited", True)], "id long, name string, compliance_status string, is_active boolean")
    postings = streams.posting_state(spark, f"{tmp_path}/postings", "title string, company string, seq long", every=2)
    keys = streams.key_state(spark, f"{tmp_path}/keys", every=2)
    add, calls = keys.add, []

    def failing(changes, number):
        calls.append(number)
        if calls.count(3) == 1 and number == 3:
            raise RuntimeError("lost")
        add(changes, number)

    keys.add = failing
    stream = lambda: streams.job_stream(streams.table_stream(spark, f"{tmp_path}/in", JOB, per_batch=1), sources, postings, keys, f"{tmp_path}/out", f"{tmp_path}/cp", F.lit(datetime(2024, 1, 1)))
    try:
        stream()
    except Exception:
        stream()
    assert calls.count(3) == 2
    held, expected = set(), {}
    for f in range(6):
        batch, fresh = data[f * 20:(f + 1) * 20], set()
        for i, source, external, url, title, company, *_ in batch:
            mine = [("hash", title, company), ("id", source, external), ("url", url)]
            if source > 1:
                expected[i] = "blocked"
                continue
            earlier = {("id", r[1], r[2]) for r in batch if r[0] < i and r[1] < 2} | {("url", r[3]) for r in batch if r[0] < i and r[1] < 2}
            expected[i] = "skipped" if held & set(mine) or earlier & set(mine) else "accepted"
            if expected[i] == "accepted":
                fresh |= set(mine)
        held |= fresh
    out = spark.read.parquet(f"{tmp_path}/out")
    assert {r["seq"]: r["outcome"] for r in out.collect()} == expected and out.count() == 120
    taken = [data[i] for i, o in expected.items() if o == "accepted"]
    assert sorted((r["title"], r["company"], r["sightings"]) for r in postings.now().collect()) == sorted(
        (t, c, len({r[0] // 20 for r in taken if r[4:6] == (t, c)})) for t, c in {r[4:6] for r in taken})


def test_minute_flushes_leave_no_python_per_key(spark):
    """Sights are reduced per minute before the state is touched, not handed one by one to Python."""
    events = spark.readStream.format("rate").load().select(F.col("timestamp").alias("ts"), F.col("value").alias("user_id"))
    plan = streams.minute_flush_stream(events, "1 day")._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "TransformWithState" not in plan


def test_a_part_lands_in_one_file_per_core(spark, tmp_path, monkeypatch):
    """A table in one file is read by all cores once it has landed, and a micro-batch is one part."""
    spark.range(400).selectExpr("id as event_id", "timestamp_seconds(id * 60) as ts").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(catalog_streams, "work_path", lambda *_: f"{tmp_path}/landed")
    catalog_streams.landed(spark, str(tmp_path), "events", "ts")
    landed = spark.read.parquet(f"{tmp_path}/landed")
    assert len(landed.inputFiles()) == catalog_streams.PARTS * spark.sparkContext.defaultParallelism
    assert sorted(r["event_id"] for r in landed.collect()) == list(range(400))


def test_match_keys_of_a_batch_are_made_once(spark, tmp_path):
    """The keys are looked up from their own table, so a batch is not prepared again for each look."""
    spark.createDataFrame([(i, 1, f"x{i}", f"https://b.example/{i}", "Data Engineer", f"Company {i}", "Berlin", None, None, None, None, None, None, None) for i in range(9)], JOB).write.parquet(f"{tmp_path}/in")
    sources = spark.createDataFrame([(1, "a", "approved", True)], "id long, name string, compliance_status string, is_active boolean")
    postings = streams.posting_state(spark, f"{tmp_path}/postings", "title string, company string, seq long")
    keys, asked = streams.key_state(spark, f"{tmp_path}/keys"), []
    look = keys.of
    keys.of = lambda touched, before=None: asked.append(touched.inputFiles()) or look(touched, before)
    streams.job_stream(streams.table_stream(spark, f"{tmp_path}/in", JOB), sources, postings, keys, f"{tmp_path}/out", f"{tmp_path}/cp", F.lit(datetime(2024, 1, 1)))
    assert asked and all(files and all("match-keys" in f for f in files) for files in asked)
    assert spark.read.parquet(f"{tmp_path}/out").filter("outcome = 'accepted'").count() == 9
