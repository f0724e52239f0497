"""Streams over the tables, and the whole-table plans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.text import content_hash
from ..operators import aggregate
from ..plans import ingest, quarantine
from ..plans.master import update_master
from ..session import kept, work_path
from ..streaming import streams
from .base import DOCS, VIEWS, _jobs_of, docs, heavy_jobs, query, sources, table
from .joins import NEAR_JOBS_SQL, NEW_DOCS, TFIDF_SQL
from .reports import DAILY_SQL
from .states import NEW, NEW_SQL, NOW, OLD, OLD_SQL, SWITCHES
from .texts import CLASS_SQL, LOC_VALUES

PARTS = 4


def landed(spark, folder, name: str, order: str, closing: dict | None = None):
    """A table as it would have landed, in files of rising `order`, and as a stream of several micro-batches.

    Each part lands in one file per core: a micro-batch is then one part, and all cores read it.
    `closing` gives the columns of one last row, landed after the others, that moves a watermark past them.
    """
    rows = table(spark, folder, name)
    place = F.col(order).cast("timestamp").cast("long") if order == "ts" else F.col(order)
    cuts = rows.agg(F.percentile_approx(place, [i / PARTS for i in range(1, PARTS)], 1000)).first()[0] or []
    part = sum((F.when(place > c, 1).otherwise(0) for c in cuts), F.lit(0))
    path = work_path(spark, "landed")
    for k in range(PARTS):
        rows.filter(part == k).repartition(spark.sparkContext.defaultParallelism).write.mode("append").parquet(path)
    per_batch = -(-len(spark.read.parquet(path).inputFiles()) // PARTS)
    if closing:
        types = dict(rows.dtypes)
        last = spark.range(1, numPartitions=1).select(*[F.lit(closing.get(c)).cast(types[c]).alias(c) for c in rows.columns])
        last.write.mode("append").parquet(path)
    return streams.table_stream(spark, path, rows.schema, per_batch=per_batch)


#: A look at nothing, long after all others: days before it are over.
LATER = {"ts": datetime(2100, 1, 1), "event_type": "view"}


def event_stream(spark, folder, closing: dict | None = None):
    return landed(spark, folder, "events", "ts", closing).selectExpr(*[f"{e} as {n}" for n, e in VIEWS.items()])


def _paths(spark, name):
    path = work_path(spark, name)
    return f"{path}/table", f"{path}/checkpoint"


@query("t1_ingest_stream", needs="docs", sql="""
select title, min(id) as first_id, count(*) as rows, count(distinct sha256(lower(title) || '|' || lower(lang) || '|' || lower(description))) as postings from docs group by title
""")
def t1(spark, folder):
    raw = landed(spark, folder, "documents", "doc_id").selectExpr(*[f"{e} as {n}" for n, e in DOCS.items()])
    path, checkpoint = _paths(spark, "ingest")

    def canonical(batch):
        return batch.select("id", "seq", "title", "lang", content_hash("title", "lang", "description").alias("content_hash"),
                            F.lit(datetime(2001, 9, 1)).alias("seen_at"))

    state = streams.posting_state(spark, path, "id long, seq long, title string, lang string", every=2)
    streams.ingest_stream(raw, state, checkpoint, canonical)
    counts = docs(spark, folder).groupBy("title").agg(F.min("id").alias("first_id"), F.count("*").alias("rows"))
    return state.now().groupBy("title").agg(F.count("*").alias("postings")).join(counts, "title")


POSTED = ("title string, company string, location string, source_id long, external_id string, url string, experience_level string, job_type string, "
          "remote_type string, salary_min int, salary_max int, seq long")


def _job_stream(spark, folder):
    """The orders as landed postings, through the whole loop in several micro-batches."""
    raw = _jobs_of(landed(spark, folder, "orders", "o_orderkey"), spark, folder)
    path, checkpoint = _paths(spark, "jobs")
    postings = streams.posting_state(spark, f"{path}/postings", POSTED, every=3)
    keys = streams.key_state(spark, f"{path}/keys", every=3)
    streams.job_stream(raw, sources(spark, folder), postings, keys, f"{path}/outcomes", checkpoint, F.lit(NOW))
    return postings, spark.read.parquet(f"{path}/outcomes")


@query("t1_job_stream", needs="jobs sources", sql=f"""
with gate as (select id from sources where compliance_status in ('approved', 'conditional') and is_active)
select source_id, count(*) as landed, source_id in (select id from gate) as taken from jobs group by 1
""")
def t1b(spark, folder):
    """Every landed posting has one outcome; those of sources that may not be processed are blocked."""
    _, outcomes = _job_stream(spark, folder)
    return outcomes.groupBy("source_id").agg(F.count("*").alias("landed"), F.max(F.col("outcome") == "accepted").alias("taken"))


@query("t2_new_posting_alerts", needs="views", sql="""
with recursive r as (
  select event_id, entity, user_id, false as taken from views
  union all
  select event_id, entity, user_id, taken from (
    select event_id, entity, user_id, taken, max(taken) over (partition by entity) as entity_taken, max(taken) over (partition by user_id) as user_taken
    from (select event_id, entity, user_id, event_id = min(event_id) over (partition by entity) and event_id = min(event_id) over (partition by user_id) as taken
          from r where not taken))
  where taken or not (entity_taken or user_taken))
select event_id, entity, user_id from r where taken
""")
def t2(spark, folder):
    path, checkpoint = _paths(spark, "alerts")
    seen = streams.seen_state(spark, f"{path}/seen", "entity", "long", every=2)
    events = streams.table_stream(spark, folder, table(spark, folder, "events").schema, "events.parquet").selectExpr(*[f"{e} as {n}" for n, e in VIEWS.items()])
    streams.drain(events, streams.alert_step(seen, f"{path}/alerts", url="user_id", order="event_id"), checkpoint, "append")
    return spark.read.parquet(f"{path}/alerts").select("event_id", "entity", "user_id")


@query("t2_alerts_over_batches", needs="views", sql="select distinct entity from views")
def t2c(spark, folder):
    """Keys alone, in several micro-batches: each key once, however often it comes again."""
    path, checkpoint = _paths(spark, "alerts")
    seen = streams.seen_state(spark, f"{path}/seen", "entity", "long", every=2)
    streams.drain(event_stream(spark, folder), streams.alert_step(seen, f"{path}/alerts", url="event_id", order="event_id"), checkpoint, "append")
    return spark.read.parquet(f"{path}/alerts").select("entity")


@query("t2_new_keys_in_bounded_state", needs="views", sql="select distinct entity from views")
def t2b(spark, folder):
    path, checkpoint = _paths(spark, "new-keys")
    fresh = streams.new_posting_stream(event_stream(spark, folder), "entity", "ts", "60 days")
    return streams.drain_to(fresh.select("entity", "ts"), path, checkpoint, "append").select("entity")


@query("t3_view_counters", needs="views", sql=DAILY_SQL)
def t3(spark, folder):
    path, checkpoint = _paths(spark, "counters")
    looks = event_stream(spark, folder).filter("event_type in ('view', 'click')")
    state = streams.latest_state(spark, path, ["entity", "day"], "entity long, day date, views long", every=2)
    return streams.drain_to_state(streams.view_counter_stream(looks, "entity", "2 days"), state, checkpoint)


@query("t4_unique_viewers", needs="views", sql="""
select entity, cast(ts as date) as day, count(distinct user_id) as viewers from views where event_type in ('view', 'click') group by 1, 2
""")
def t4(spark, folder):
    path, checkpoint = _paths(spark, "viewers")
    looks = event_stream(spark, folder, closing=LATER).filter("event_type in ('view', 'click')")
    days = streams.drain_to(streams.daily_viewer_stream(looks, "entity", "2 days"), path, checkpoint, "append")
    return days.filter("entity is not null").select("entity", "day", "viewers")


@query("t5_online_users", needs="views", sql="""
select user_id, date_trunc('hour', ts)::timestamp as hour, max(ts) as last_seen from views group by 1, 2
""")
def t5(spark, folder):
    path, checkpoint = _paths(spark, "online")
    state = streams.latest_state(spark, path, ["user_id", "hour"], "user_id long, hour timestamp, last_seen timestamp", every=2)
    return streams.drain_to_state(streams.online_stream(event_stream(spark, folder), "2 days"), state, checkpoint)


@query("t5_minute_flushes", needs="views", sql="""
select user_id, date_trunc('minute', ts)::timestamp as minute, max(ts) as last_seen from views group by 1, 2
""")
def t5b(spark, folder):
    path, checkpoint = _paths(spark, "flushes")
    flushed = streams.minute_flush_stream(event_stream(spark, folder, closing=LATER), "2 days")
    return streams.drain_to(flushed, path, checkpoint, "append").filter("user_id is not null").select("user_id", "minute", "last_seen")


@query("t6_toggles", needs="views", sql=f"""
with e as (select *, lag(active) over (partition by user_id, entity order by ts, event_id) as before from ({SWITCHES}))
select entity, count(*) as changes, cast(sum(case when active then 1 else -1 end) as bigint) as user_count from e where before is null or before <> active group by 1
""")
def t6(spark, folder):
    path, checkpoint = _paths(spark, "toggles")
    events = event_stream(spark, folder).filter("event_type in ('signup', 'purchase', 'error')").selectExpr(
        "event_id", "ts", "user_id", "entity", "event_type in ('signup', 'purchase') as active")
    state = streams.toggle_state(spark, f"{path}-state", ["user_id", "entity"], "user_id long, entity long, ts timestamp, event_id long, active boolean", every=2)
    streams.drain(events, streams.toggle_step(path, state), checkpoint, "append")
    return spark.read.parquet(path).groupBy("entity").agg(F.count("*").alias("changes"), F.sum("diff").alias("user_count"))


# Whole plans.

TITLES = {  # Raw titles of the job data -> normalised, worked out by hand.
    "Sr. SWE": "Senior Software Engineer", "junior dev": "Junior Developer", "Staff SRE": "Staff Site Reliability Engineer",
    "ml eng": "Machine Learning Engineer", "vp of engineering": "Vice President Of Engineering", "QA Analyst II": "QA Analyst II",
    "Software Engineering Intern": "Software Engineering Intern", "  Data   Engineer": "Data Engineer",
    "tpm, payments": "Technical Program Manager Payments", "Lead iOS Developer": "Lead Ios Developer",
    "Principal Researcher": "Principal Researcher", "Support Associate (part-time)": "Support Associate (part-time)",
    "Machine Learning Engineer": "Machine Learning Engineer",
}
TITLE_VALUES = ", ".join("('{}', '{}')".format(*kv) for kv in TITLES.items())
URL_KEY = "cast(id % 9000 as varchar) || '-' || cast(id % 3 as varchar)"
PLAN_SQL = f"""
titles(raw_title, good_title) as (values {TITLE_VALUES}),
places(raw, city, state, state_code, country, country_code, is_remote, label) as (values {LOC_VALUES}),
b as (select *, {URL_KEY} as u from jobs where {OLD_SQL}), r as (select *, {URL_KEY} as u from jobs where {NEW_SQL}),
gate as (select id, case when compliance_status = 'prohibited' then 'Source is PROHIBITED by terms of service'
  when compliance_status = 'pending_review' then 'Source compliance is pending review' when not is_active then 'Source is not active' end as reason from sources),
open as (select r.* from r join gate on r.source_id = gate.id where reason is null),
exact as (select *, content_hash in (select content_hash from b) or (source_id, external_id) in (select source_id, external_id from b) or u in (select u from b)
  or id > min(id) over (partition by source_id, external_id) or id > min(id) over (partition by u) as same from open),
{NEAR_JOBS_SQL.format(new='select id, description from exact where not same', existing='select id, description from b').strip()},
seen as (select *, same or id in (select duplicate_id from near) as dup from exact),
ok as (select seen.id, seen.source_id, good_title as title, company, description, case when coalesce(location, '') = '' then location else label end as location from seen
  join titles on seen.title = raw_title join places on coalesce(location, '') = raw where not dup),
h as (select *, sha256(lower(title) || '|' || lower(company) || '|' || lower(coalesce(location, ''))) as hash from ok),
c as (select h.id, h.source_id, h.hash, cls.experience_level as level, h.hash not in (select content_hash from b) and h.id = min(h.id) over (partition by h.hash) as fresh
  from h join ({CLASS_SQL.format(place='location', table='ok')}) cls on h.id = cls.id)
"""


def _plan(spark, folder):
    rows = heavy_jobs(spark, folder)
    stored, batch = rows.filter(F.col("posted_date") < F.lit(OLD)), rows.filter(F.col("posted_date") >= F.lit(NEW))
    return kept(ingest.process(batch, stored, sources(spark, folder)), "processed"), stored


REPORT_SQL = f"""
a as (select source_id, count(*) as total_scraped, count(*) filter (dup) as duplicates_skipped from seen group by 1),
n as (select source_id, count(*) filter (fresh) as new_jobs, count(*) filter (not fresh) as updated_jobs, count(*) filter (level in ('entry', 'intern')) as entry_level,
  count(*) filter (level = 'mid') as mid_level, count(*) filter (level in ('senior', 'lead', 'staff', 'principal')) as senior_level from c group by 1),
report as (select r.source_id, coalesce(a.total_scraped, 0) as total_scraped, coalesce(a.duplicates_skipped, 0) as duplicates_skipped, coalesce(new_jobs, 0) as new_jobs,
  coalesce(updated_jobs, 0) as updated_jobs, coalesce(entry_level, 0) as entry_level, coalesce(mid_level, 0) as mid_level, coalesce(senior_level, 0) as senior_level,
  case when gate.id is null then 'Source is not registered' else reason end as error
  from (select distinct source_id from r) r left join a on r.source_id = a.source_id left join n on r.source_id = n.source_id left join gate on r.source_id = gate.id)
"""


@query("p1_run_report", needs="jobs sources", sql="with " + PLAN_SQL.strip() + ", " + REPORT_SQL.strip() + " select * from report")
def p1(spark, folder):
    processed, stored = _plan(spark, folder)
    return ingest.run_report(processed, stored)


@query("p1_next_table", needs="jobs sources", sql="with " + PLAN_SQL.strip() + f""",
o as (select hash, min(id) as seq from c group by 1)
select b.id, b.content_hash, case when o.seq is null then 'kept' else 'updated' end as action from b left join o on b.content_hash = o.hash
union all select (select max(id) from b) + row_number() over (order by seq), hash, 'inserted' from o where hash not in (select content_hash from b)
""")
def p1b(spark, folder):
    processed, stored = _plan(spark, folder)
    return ingest.next_table(processed, stored, datetime(2001, 9, 1)).select("id", "content_hash", "action")


@query("p2_batch_report", needs="jobs sources", sql="with " + PLAN_SQL.strip() + ", " + REPORT_SQL.strip() + """
select count(*) as sources, cast(sum(total_scraped) as bigint) as total_scraped, cast(sum(new_jobs) as bigint) as new_jobs, cast(sum(duplicates_skipped) as bigint) as duplicates_skipped,
  count(*) filter (error is not null) as failed, round(100.0::double * count(*) filter (error is null) / count(*), 2) as success_rate from report
""")
def p2(spark, folder):
    processed, stored = _plan(spark, folder)
    return aggregate.batch_statistics(ingest.run_report(processed, stored))


LANDED = "seq long, source_id long, title string, company string, location string, url string, salary_min int"
BROKEN = {7: "substr({0}, 1, 40)", 11: "''", 13: "replace({0}, '\"salary_min\":', '\"salary_min\":\"much\",\"was\":')", 17: "replace({0}, '\"title\":', '\"titel\":')"}


@query("p2_quarantine", needs="jobs", sql="""
with w as (select source_id, case when id % 7 = 0 then 'Unreadable record' when id % 11 = 0 then 'Empty record' when id % 13 = 0 and salary_min is not null then 'Unreadable record'
  when id % 17 = 0 then 'Missing title' end as reason from jobs)
select source_id, count(*) as landed, count(*) filter (reason is null) as readable, count(*) filter (reason = 'Empty record') as empty,
  count(*) filter (reason = 'Unreadable record') as broken, count(*) filter (reason = 'Missing title') as untitled from w group by 1
""")
def p2b(spark, folder):
    """Postings as they land, one text each, some of them broken: every record is read or set aside with its reason."""
    fields = [f.split()[0] for f in LANDED.split(", ")]
    rows = heavy_jobs(spark, folder).select("id", "source_id", F.to_json(F.struct(*fields)).alias("payload"))
    case = "case " + " ".join(f"when id % {k} = 0 then {e.format('payload')}" for k, e in BROKEN.items()) + " else payload end"
    records = quarantine.read_landed(rows.select("id", "source_id", F.expr(case).alias("payload")), LANDED)
    good, bad = quarantine.set_aside(records, ["source_id"])
    path = work_path(spark, "quarantine")
    bad.write.parquet(path)
    bad = spark.read.parquet(path)
    counts = good.groupBy("source_id").agg(F.count("*").alias("readable")).join(
        bad.groupBy("source_id").agg(F.count("*").alias("aside"), *[F.count_if(F.col("reason") == r).alias(n) for n, r in (
            ("empty", "Empty record"), ("broken", "Unreadable record"), ("untitled", "Missing title"))]), "source_id", "full")
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return counts.select("source_id", (n("readable") + n("aside")).alias("landed"), *[n(c).alias(c) for c in ("readable", "empty", "broken", "untitled")])


LIST_COLUMNS = {"status": "case when id % 9 = 0 then 'REJECTED' else 'NEW' end", "company": "lang",
          "remoteness": "case when id % 2 = 0 then 'UNKNOWN' else 'FULLY_REMOTE' end"}


@query("p3_master_update", needs="docs", sql="""
with rows as (select id, source_id, key_id, title, description, lang as company, case when id % 9 = 0 then 'REJECTED' else 'NEW' end as status,
  cast(date '2001-01-01' + cast(id * 37 % 300 as int) as timestamp) as post_date from docs),
kept as (select * from rows where status = 'NEW' and post_date >= timestamp '2001-02-01' and id % 10 <> 7),
hits as (""" + TFIDF_SQL.format(
    clean="select id, source_id, description as text from kept where not (source_id % 4 = 0 and id % 14 = 8)", new=NEW_DOCS, least=0, stop="''", grams="ws",
    corpus="select * from e union all select * from n", fitted="true", top="", threshold=0.75).strip() + """),
offer as (select * from (select h.original_id, k.*, row_number() over (partition by h.original_id order by k.post_date desc, k.id desc) as rn from hits h join kept k on h.duplicate_id = k.id) where rn = 1)
select m.id, case when o.post_date >= m.post_date then o.key_id else m.key_id end as key_id, m.title, greatest(m.post_date, coalesce(o.post_date, m.post_date)) as post_date,
  coalesce(o.post_date >= m.post_date, false) as updated from kept m left join offer o on m.id = o.original_id where m.source_id % 4 <> 0
union all select id, key_id, title, post_date, false from kept where source_id % 4 = 0 and id % 14 <> 8 and id not in (select duplicate_id from hits)
""")
def p3(spark, folder):
    rows = docs(spark, folder).select(
        "id", "source_id", "key_id", "title", "description", F.expr(LIST_COLUMNS["company"]).alias("company"), F.expr(LIST_COLUMNS["status"]).alias("status"),
        F.expr(LIST_COLUMNS["remoteness"]).alias("remoteness"),
        F.expr("cast(date_add(date '2001-01-01', cast(id * 37 % 300 as int)) as timestamp)").alias("post_date"))
    blocked = rows.filter("id % 10 = 7").select("key_id", "title", "status")
    known = rows.filter(f"{NEW_DOCS} and id % 14 = 8").select("key_id")
    new_list, _, _ = update_master(rows.filter(f"not ({NEW_DOCS})").drop("source_id"), rows.filter(NEW_DOCS).drop("source_id"), blocked,
                                known, oldest=datetime(2001, 2, 1))
    return new_list.select("id", "key_id", "title", "post_date", "updated")
