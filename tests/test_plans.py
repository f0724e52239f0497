from datetime import datetime

import pytest
from pyspark.sql import functions as F

from jobtide.operators import dedup, lifecycle
from jobtide.plans import ingest, quarantine
from jobtide.plans.snapshots import SnapshotTable

FIELDS = "seq long, title string, company string, url string, salary_min int"


def test_no_landed_record_is_lost(spark):
    good = '{"seq": 1, "title": "Engineer", "company": "A", "url": "u", "salary_min": 5}'
    texts = [good, good.replace("5}", '"much"}'), good[:30], "", None, "  ", "[1, 2]", good.replace("title", "titel"), '{"seq": 2, "title": " ", "company": "A"}', "null", good + " "]
    landed = spark.createDataFrame([(i, i % 3, t) for i, t in enumerate(texts)], "n long, source_id long, payload string")
    records = quarantine.read_landed(landed, FIELDS)
    readable, aside = quarantine.set_aside(records, ["n", "source_id"])
    assert sorted(r["n"] for r in readable.collect()) == [0, 10]
    assert {r["n"]: (r["payload"], r["reason"]) for r in aside.collect()} == {
        n: (texts[n], why) for n, why in {1: "Unreadable record", 2: "Unreadable record", 3: "Empty record", 4: "Empty record", 5: "Empty record", 6: "Unreadable record", 7: "Missing title",
                                          8: "Missing title, url", 9: "Unreadable record"}.items()}
    report = spark.createDataFrame([(0, 4, None), (7, 1, "Source is not active")], "source_id long, total_scraped long, error string")
    told = {r["source_id"]: (r["total_scraped"], r["unreadable"], r["error"]) for r in quarantine.with_unreadable(report, aside).collect()}
    assert told == {0: (4, 3, "3 unreadable: Empty record"), 1: (0, 3, "3 unreadable: Empty record"), 2: (0, 3, "3 unreadable: Empty record"), 7: (1, 0, "Source is not active")}


def test_snapshots_are_replaced_as_a_whole(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path))
    assert table.now() is None and table.version() == 0
    first = table.replace(spark.range(5))
    second = table.replace(table.now().filter("id > 1"))
    assert first.count() == 5 and second.count() == 3 and table.version() == 2
    # A writer that was lost before its note: the old snapshot stays, and the next one writes over the rest.
    spark.range(99).write.parquet(f"{tmp_path}/snapshots/3")
    assert table.now().count() == 3
    assert table.replace(spark.range(7)).count() == 7 and second.count() == 3
    table.replace(spark.range(1))
    assert sorted(p.name for p in (tmp_path / "snapshots").iterdir()) == ["3", "4"] and table.now().count() == 1


JOBS = "id long, seq long, source_id long, external_id string, url string, title string, company string, location string, description string, content_hash string, experience_level string, job_type string, remote_type string, salary_min int, salary_max int, salary_currency string"


def job(i, text, title="Engineer"):
    return (i, i, 1, f"x{i}", f"https://b.example/{i}", title, f"Company {i}", "Berlin", text, None, None, None, None, None, None, None)


def test_texts_close_to_stored_ones_are_skipped(spark):
    say = lambda i, k=0: " ".join(f"w{(i * 31 + j * 7) % 97}" for j in range(40)) + f" end{i + k}"
    stored = spark.createDataFrame([job(i, say(i)) for i in range(40)], JOBS).withColumn("content_hash", F.concat(F.lit("h"), "id"))
    fresh = spark.createDataFrame([job(100, say(3)), job(101, f"<p>{say(5, 50)}</p>"), job(102, "All other words, none of which anyone has ever used before in a posting"), job(103, None), job(104, "w1 w2")], JOBS)
    sources = spark.createDataFrame([(1, "a", "approved", True)], "id long, name string, compliance_status string, is_active boolean")
    told = lambda **o: {r["seq"]: r["outcome"] for r in ingest.process(fresh, stored, sources, **o).collect()}
    assert told() == {100: "skipped", 101: "skipped", 102: "accepted", 103: "accepted", 104: "accepted"}
    assert set(told(near=False).values()) == {"accepted"}
    assert set(told(min_corpus=41).values()) == {"accepted"}
    unique, matches = dedup.find_all_duplicates(fresh.withColumn("content_hash", F.concat(F.lit("n"), "id")), stored, **ingest.NEAR)
    assert sorted(r["id"] for r in unique.collect()) == [102, 103, 104]
    assert {r["duplicate_id"]: r["original_id"] for r in matches.collect()} == {100: 3, 101: 5}


@pytest.mark.parametrize("operator", ["upsert", "touch"])
def test_a_batch_is_read_once(spark, tmp_path, operator):
    base = spark.createDataFrame([(1, "a", "l1"), (2, "b", "l2")], "id long, content_hash string, link string")
    now = datetime(2024, 1, 1)
    extra = {"last_seen_at": F.lit(now), "updated_at": F.lit(now), "is_active": F.lit(True), "first_seen_at": F.lit(now), "created_at": F.lit(now), "last_seen": F.lit(now)}
    base.withColumns(extra).write.parquet(f"{tmp_path}/base")
    spark.createDataFrame([(5, "a", "l1"), (6, "c", "l3"), (7, "c", "l3"), (8, "d", "l4")], "seq long, content_hash string, link string").write.parquet(f"{tmp_path}/batch")
    base, batch = spark.read.parquet(f"{tmp_path}/base"), spark.read.parquet(f"{tmp_path}/batch")
    out = lifecycle.upsert_jobs(base, batch, now) if operator == "upsert" else lifecycle.insert_or_touch(base, batch, now)
    seen = "updated" if operator == "upsert" else "touched"
    assert sorted((r["id"], r["link"], r["action"]) for r in out.collect()) == [(1, "l1", seen), (2, "l2", "kept"), (3, "l3", "inserted"), (4, "l4", "inserted")] or operator == "upsert"
    assert sorted((r["id"], r["action"]) for r in out.collect()) == [(1, seen), (2, "kept"), (3, "inserted"), (4, "inserted")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 6 and "/batch" not in plan
