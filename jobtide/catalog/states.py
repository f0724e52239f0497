"""Upserts, syncs, patches and change histories over snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import lifecycle
from ..plans.snapshots import SnapshotTable
from ..session import work_path
from ..sources.registry import register_sources
from .base import codes, companies, jobs, pick, query, sources, vacancies, views
from .rows import master

NOW = datetime(2001, 9, 1)
NOW_SQL = "timestamp '2001-09-01'"
OLD, NEW = datetime(1999, 1, 1), datetime(1997, 6, 1)
# The stored table holds postings before 1999, the batch those since June 1997.
OLD_SQL, NEW_SQL = "posted_date < timestamp '1999-01-01'", "posted_date >= timestamp '1997-06-01'"


def _tables(spark, folder):
    rows = jobs(spark, folder)
    return rows.filter(F.col("posted_date") < F.lit(OLD)), rows.filter(F.col("posted_date") >= F.lit(NEW))


@query("u1_upsert", needs="jobs", sql=f"""
with b as (select * from jobs where {OLD_SQL}), n as (select content_hash, min(seq) as seq from jobs where {NEW_SQL} group by 1)
select b.id, b.content_hash, b.first_seen_at, case when n.seq is null then b.last_seen_at else {NOW_SQL} end as last_seen_at,
  b.is_active or n.seq is not null as is_active, case when n.seq is null then 'kept' else 'updated' end as action from b left join n on b.content_hash = n.content_hash
union all select (select max(id) from b) + row_number() over (order by seq), content_hash, {NOW_SQL}, {NOW_SQL}, true, 'inserted' from n where content_hash not in (select content_hash from b)
""")
def u1(spark, folder):
    stored, batch = _tables(spark, folder)
    return lifecycle.upsert_jobs(stored, batch, NOW).select(
        "id", "content_hash", "first_seen_at", "last_seen_at", "is_active", "action")


LATE_SQL = "posted_date >= timestamp '2000-01-01'"


@query("u1_versioned_upserts", needs="jobs", sql=f"""
with b as (select * from jobs where {OLD_SQL}), n as (select content_hash, min(seq) filter (not {LATE_SQL}) as early, min(seq) as any_seq from jobs where {NEW_SQL} group by 1),
f as (select *, case when early is null then 1 else 0 end as batch, coalesce(early, any_seq) as seq from n where content_hash not in (select content_hash from b))
select id, content_hash from b
union all select (select max(id) from b) + row_number() over (order by batch, seq), content_hash from f
""")
def u1b(spark, folder):
    """Two batches one after the other, each a new version of the stored snapshot."""
    stored, batch = _tables(spark, folder)
    late = F.col("posted_date") >= F.lit(datetime(2000, 1, 1))
    snapshots = SnapshotTable(spark, work_path(spark, "snapshots"))
    snapshots.replace(stored)
    for part in (batch.filter(~late), batch.filter(late)):
        snapshots.replace(lifecycle.upsert_jobs(snapshots.now(), part, NOW).drop("action"))
    return snapshots.now().select("id", "content_hash")


@query("u2_mark_inactive", needs="jobs", sql=f"""
select id, is_active and not (source_id = 3 and last_seen_at < timestamp '2000-01-01') as is_active,
  case when is_active and source_id = 3 and last_seen_at < timestamp '2000-01-01' then {NOW_SQL} else updated_at end as updated_at,
  case when is_active and source_id = 3 and last_seen_at < timestamp '2000-01-01' then 'deactivated' else 'kept' end as action from jobs
""")
def u2(spark, folder):
    return lifecycle.mark_inactive(jobs(spark, folder), 3, datetime(2000, 1, 1), NOW).select(
        "id", "is_active", "updated_at", "action")


@query("u3_source_patch", needs="sources", sql="""
select id, case when id % 2 = 0 then name || '_v2' else name end as name, case when id % 5 = 0 then 'prohibited' else compliance_status end as compliance_status, is_active from sources
""")
def u3(spark, folder):
    rows = sources(spark, folder)
    patch = rows.select("id", F.when(F.col("id") % 2 == 0, F.concat("name", F.lit("_v2"))).alias("name"),
                        F.when(F.col("id") % 5 == 0, "prohibited").alias("compliance_status"))
    return lifecycle.patch_rows(rows, patch).select("id", "name", "compliance_status", "is_active")


TRACKER = ["id", "seq", "link", "title", "company_id", "description", "location", "posted_date", "salary_min", "salary_max",
           "favorite", "notes", "application_status", "application_date", "archived", "last_seen", "content_hash"]
HASH_SQL = ("md5({t} || coalesce(description, '') || coalesce(location, '') || case when company_id = 0 then 'unknown' else cast(company_id as varchar) end"
            " || case when salary_min is null then '' else cast(salary_min as varchar) || '-' || cast(salary_max as varchar) end || strftime(posted_date, '%Y-%m-%dT%H:%M:%S'))")
CHANGED = "case when id % 3 = 0 then title || ' (new)' else title end"
SYNC_SQL = f"""
b as (select * replace ({HASH_SQL.format(t='title')} as content_hash) from jobs where {OLD_SQL}),
s as (select link, min(seq) as seq, min(case when id % 3 = 0 then title || ' (new)' else title end) as title, min({HASH_SQL.format(t='(' + CHANGED + ')')}) as h from jobs where {NEW_SQL} group by link),
j as (select b.*, s.seq is not null as here, s.h as h, s.title as new_title, coalesce(favorite, false) or trim(notes) <> '' or application_status <> 'New' as mine from b left join s on b.link = s.link),
synced as (select id, link, case when here and h <> content_hash then new_title else title end as title, case when here then {NOW_SQL} else last_seen end as last_seen,
  not here and (archived or mine) as archived, case when here and (h <> content_hash or archived) then 'updated' when here then 'skipped' when archived then 'kept' when mine then 'archived' else 'deleted' end as action from j
  union all select (select max(id) from b) + row_number() over (order by seq), link, title, {NOW_SQL}, false, 'inserted' from s where link not in (select link from b))
"""


def _sync(spark, folder):
    stored, batch = _tables(spark, folder)
    stored = stored.select(*TRACKER).withColumn("content_hash", lifecycle.scraped_hash())
    batch = batch.select(*TRACKER).withColumn("title", F.expr(CHANGED))
    return stored, batch


@query("u4_snapshot_sync", needs="jobs", sql="with " + SYNC_SQL.strip() + " select * from synced")
def u4(spark, folder):
    return lifecycle.sync_jobs(*_sync(spark, folder), NOW).select("id", "link", "title", "last_seen", "archived", "action")


@query("u4_sync_counts", needs="jobs", sql="with " + SYNC_SQL.strip() + """
select count(*) filter (action = 'inserted') as inserted, count(*) filter (action = 'updated') as updated, count(*) filter (action = 'skipped') as skipped,
  count(*) filter (action = 'archived') as archived, count(*) filter (action = 'deleted') as deleted from synced
""")
def u4b(spark, folder):
    stored, batch = _sync(spark, folder)
    return lifecycle.sync_counts(lifecycle.sync_jobs(stored, batch, NOW), batch)


@query("u5_stale_rows", needs="jobs", sql=f"""
with cur as (select link from jobs where {NEW_SQL}), b as (select *, favorite or trim(notes) <> '' or application_status <> 'New' as mine from jobs where {OLD_SQL})
select id, archived or link not in (select link from cur) as archived, case when archived or link in (select link from cur) then 'kept' else 'archived' end as action
from b where archived or mine or link in (select link from cur)
""")
def u5(spark, folder):
    stored, current = _tables(spark, folder)
    return lifecycle.handle_stale(stored, current.select("link")).select("id", "archived", "action")


@query("u6_retention", needs="jobs", sql="""
select id from jobs where not (archived and last_seen < timestamp '2001-09-01' - interval 90 days
  and (application_date is null or application_date < timestamp '2001-09-01' - interval 90 days))
""")
def u6(spark, folder):
    return lifecycle.retire_old(jobs(spark, folder), NOW).select("id")


@query("u7_user_edits", needs="jobs", sql=f"""
select id, case when id % 4 = 0 then 'Applied' else application_status end as application_status, case when id % 10 = 0 then 'mine' else notes end as notes,
  case when id % 4 = 0 and application_status <> 'Applied' and application_date is null then {NOW_SQL} else application_date end as application_date from jobs
""")
def u7(spark, folder):
    rows = jobs(spark, folder)
    edits = rows.select("id", F.when(F.col("id") % 4 == 0, "Applied").alias("application_status"),
                        F.when(F.col("id") % 10 == 0, "mine").alias("notes"))
    return lifecycle.edit_jobs(rows, edits, NOW).select("id", "application_status", "notes", "application_date")


@query("u8_update_if_newer", needs="master views", sql="""
with m as (select * from master where post_date < timestamp '1998-01-01'),
o as (select event_id // 3 as original_id, event_id as id, cast(date '1996-01-01' + cast(event_id * 37 % 700 as int) as timestamp) as post_date, 'Buyer ' || cast(user_id as varchar) as company from views),
p as (select * from (select *, row_number() over (partition by original_id order by post_date desc, id desc) as rn from o) where rn = 1)
select m.id, m.title, case when p.post_date >= m.post_date then p.company else m.company end as company, greatest(m.post_date, coalesce(p.post_date, m.post_date)) as post_date,
  coalesce(p.post_date >= m.post_date, false) as updated from m left join p on m.id = p.original_id
""")
def u8(spark, folder):
    rows = master(spark, folder).filter("post_date < timestamp '1998-01-01'").select("id", "title", "company", "post_date")
    offers = views(spark, folder).selectExpr(
        "event_id div 3 as original_id", "event_id as duplicate_id", "'offer' as title",
        "cast(date_add(date '1996-01-01', cast(event_id * 37 % 700 as int)) as timestamp) as post_date",
        "'Buyer ' || cast(user_id as string) as company")
    incoming = offers.select(F.col("duplicate_id").alias("id"), "title", "company", "post_date")
    return lifecycle.update_if_newer(rows, offers.select("original_id", "duplicate_id"), incoming)


@query("u9_block_list", needs="master", sql="""
with b as (select key_id, title, status from master where post_date < timestamp '1996-01-01')
select * from b union all select key_id, title, status from master where status in ('DELETE', 'ARCHIVE', 'REJECTED', 'OLD') and key_id not in (select key_id from b)
""")
def u9(spark, folder):
    rows = master(spark, folder)
    blocked = rows.filter("post_date < timestamp '1996-01-01'").select("key_id", "title", "status")
    return lifecycle.grow_block_list(blocked, rows, fixed.MASTER_REMOVE_STATUSES)


# On/off events: a sign-up or purchase switches on, an error switches off.
ACTIVE = "event_type in ('signup', 'purchase')"
SWITCHES = "select *, event_type in ('signup', 'purchase') as active from views where event_type in ('signup', 'purchase', 'error')"


def switches(spark, folder):
    return views(spark, folder).filter("event_type in ('signup', 'purchase', 'error')").withColumn("active", F.expr(ACTIVE))


@query("u10_switch_state", needs="views", sql=f"""
with e as (select *, lag(active) over (partition by user_id, entity order by ts, event_id) as before from ({SWITCHES}))
select user_id, entity, arg_max(active, (ts, event_id)) as active, min(ts) as created_at, max(ts) filter (before is null or before <> active) as updated_at from e group by 1, 2
""")
def u10(spark, folder):
    return lifecycle.switch_state(switches(spark, folder), ["user_id", "entity"])


@query("u11_bridge_rows", needs="views", sql=f"""
select user_id, entity, arg_max(active, (ts, event_id)) as active, min(ts) as created_at, max(ts) as updated_at from ({SWITCHES}) group by 1, 2
""")
def u11(spark, folder):
    return lifecycle.latest_links(switches(spark, folder), ["user_id", "entity"])


@query("u12_get_or_create_companies", needs="jobs companies", sql="""
with k as (select id, name from companies where active), w as (select company as name, min(seq) as seq from jobs where trim(company) <> '' group by 1)
select id, name from k union all select (select max(id) from k) + row_number() over (order by seq), name from w where name not in (select name from k)
""")
def u12(spark, folder):
    known = companies(spark, folder).filter("active").select("id", "name")
    wanted = jobs(spark, folder).select(F.col("company").alias("name"), "seq")
    return lifecycle.get_or_create_companies(known, wanted)


@query("u13_stable_codes", needs="vacancies", sql="""
with k as (select url, min(id) + 5 as id from vacancies where date < date '1997-01-01' and url <> '' group by 1),
f as (select url, min(seq) as seq, arg_min(ignore, seq) as ignore from vacancies where url <> '' group by 1)
select k.id, f.url from f join k on f.url = k.url union all
select (select max(id) from k) + row_number() over (order by seq), url from f where not ignore and url not in (select url from k)
""")
def u13(spark, folder):
    rows = vacancies(spark, folder).filter("url <> ''")
    known = rows.filter("date < date '1997-01-01'").groupBy("url").agg((F.min("id") + 5).alias("id"))
    return lifecycle.stable_codes(known, rows.select("url", "seq", "ignore"), "url")


@query("u14_insert_or_touch", needs="jobs", sql=f"""
with b as (select * from jobs where {OLD_SQL}), n as (select link, min(seq) as seq from jobs where {NEW_SQL} group by 1)
select b.id, b.link, case when n.seq is null then b.last_seen else {NOW_SQL} end as last_seen, case when n.seq is null then 'kept' else 'touched' end as action from b left join n on b.link = n.link
union all select (select max(id) from b) + row_number() over (order by seq), link, {NOW_SQL}, 'inserted' from n where link not in (select link from b)
""")
def u14(spark, folder):
    stored, batch = _tables(spark, folder)
    return lifecycle.insert_or_touch(stored.select(*TRACKER), batch.select(*TRACKER), NOW).select("id", "link", "last_seen", "action")


@query("u15_drop_empty_sources", needs="sources jobs", sql="""
with s as (select id, name from sources union all select id + 1000, 'idle ' || name from sources)
select id, name from s where id in (select source_id from jobs)
""")
def u15(spark, folder):
    """Every source and an idle one beside it, which has no jobs."""
    rows = sources(spark, folder).select("id", "name")
    idle = rows.select((F.col("id") + 1000).alias("id"), F.concat(F.lit("idle "), "name").alias("name"))
    return lifecycle.drop_empty_sources(rows.unionByName(idle), jobs(spark, folder)).select("id", "name")


@query("u16_switch_companies", needs="companies", sql="select id, active and not github_verified as active from companies")
def u16(spark, folder):
    rows = companies(spark, folder)
    return lifecycle.switch_companies(rows, rows.filter("github_verified").select("id"), False).select("id", "active")


@query("u16_delete_companies", needs="companies", sql="select id, name from companies where not github_verified")
def u16b(spark, folder):
    rows = companies(spark, folder)
    return lifecycle.switch_companies(rows, rows.filter("github_verified").select("id"), None).select("id", "name")


MAIL = pick("event_id", "Ann@Example.com", "ann@example.com", "ann@example.com", "bob@example.com")
USERNAME = pick("event_id", "Ann", "ann", "ANN", "ann", "ann2")
PERSON = pick("event_id", "Ann B", "Ann B", "ann b")


@query("u17_profile_history", needs="views", sql=f"""
with e as (select event_id, user_id, ts, {MAIL} as email, {USERNAME} as username, {PERSON} as name from views),
l as (select *, lag(email) over w as e0, lag(username) over w as u0, lag(name) over w as n0 from e window w as (partition by user_id order by ts, event_id))
select user_id as profile_id, ts, lower(email) as email, username, name, lower(email) <> lower(e0) or lower(username) <> lower(u0) or lower(name) <> lower(n0) as history
from l where e0 is not null and (lower(email) <> lower(e0) or username <> u0 or name <> n0)
""")
def u17(spark, folder):
    events = views(spark, folder).selectExpr(
        "event_id", "user_id as profile_id", "ts", f"{MAIL} as email", f"{USERNAME} as username", f"{PERSON} as name")
    return lifecycle.profile_changes(events)


@query("s5_source_registry", needs="sources companies", sql="""
with s as (select id, name, base_url, scraper_type, compliance_status, is_active from sources),
w as (select 'src' || cast(id % 40 as varchar) as company, case id % 4 when 0 then 'board' when 1 then 'greenhouse' when 2 then 'lever' else 'amazon_jobs' end as kind, min(id) as seq from companies group by 1, 2),
n as (select *, company || '_' || kind as name from w)
select * from s union all select (select max(id) from s) + row_number() over (order by seq), name, case kind when 'greenhouse' then 'https://boards-api.greenhouse.io/v1/boards/' || company
  when 'lever' then 'https://api.lever.co/v0/postings/' || company when 'amazon_jobs' then 'https://www.amazon.jobs/en/search' else 'https://' || company || '.com/careers' end, kind, 'conditional', true
from n where name not in (select name from s)
""")
def s5(spark, folder):
    wanted = companies(spark, folder).selectExpr(
        "'src' || cast(id % 40 as string) as company", f"{pick('id', 'board', 'greenhouse', 'lever', 'amazon_jobs')} as scraper_type", "id as seq")
    return register_sources(sources(spark, folder), wanted)


@query("j5_stale_codes", needs="vacancies codes", sql="select distinct alias from vacancies where alias not in (select alias from codes)")
def j5c(spark, folder):
    return vacancies(spark, folder).select("alias").distinct().join(codes(spark, folder), "alias", "left_anti")
