"""Counts, rates, series and summaries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ..operators import aggregate, lifecycle, series
from ..operators.filters import export_select
from ..operators.keyed import with_previous
from ..sources import sinks
from ..sources.lists import flatten_vacancies
from .base import companies, docs, jobs, pick, query, sources, table, vacancies, views
from .states import SWITCHES, switches

AS_OF = datetime(2001, 8, 2)
START, END = date(2024, 1, 1), date(2024, 2, 5)
DAYS = "select cast(d as date) as day from (select unnest(generate_series(timestamp '2024-01-01', timestamp '2024-02-05', interval 1 day)) as d)"


@query("a1_job_totals", needs="jobs", sql="""
select count(*) as total_jobs, count(*) filter (is_active) as active_jobs, count(distinct company) as unique_companies, count(distinct source_id) as sources_with_jobs from jobs
""")
def a1(spark, folder):
    return aggregate.job_totals(jobs(spark, folder))


@query("a2_export_summary", needs="jobs sources", sql="""
with e as (select j.* from jobs j join sources s on j.source_id = s.id where j.is_active and s.compliance_status in ('approved', 'conditional'))
select 'total' as section, 'all' as label, count(*) as jobs from e
union all select 'level', coalesce(experience_level, 'unknown'), count(*) from e group by 2
union all select * from (select 'company', company, count(*) as n from e group by 2 order by n desc, company limit 10)
""")
def a2(spark, folder):
    return aggregate.export_summary(export_select(jobs(spark, folder), sources(spark, folder)))


OUTCOME = pick("id", "skipped", "inserted", "updated", "inserted")
LEVEL = pick("id", "entry", "mid", "senior", "unknown", "intern", "staff", "executive")
RUN_SQL = f"""select source_id, count(*) as total_scraped, count(*) filter (outcome = 'skipped') as duplicates_skipped, count(*) filter (outcome = 'inserted') as new_jobs,
  count(*) filter (outcome = 'updated') as updated_jobs, count(*) filter (outcome <> 'skipped' and level in ('entry', 'intern')) as entry_level,
  count(*) filter (outcome <> 'skipped' and level = 'mid') as mid_level, count(*) filter (outcome <> 'skipped' and level in ('senior', 'lead', 'staff', 'principal')) as senior_level
  from (select source_id, {OUTCOME} as outcome, {LEVEL} as level from jobs) group by 1"""


def _runs(spark, folder):
    return aggregate.run_statistics(jobs(spark, folder).selectExpr("source_id", f"{OUTCOME} as outcome", f"{LEVEL} as level"))


@query("a3_run_statistics", needs="jobs", sql=RUN_SQL)
def a3(spark, folder):
    return _runs(spark, folder)


@query("a4_batch_statistics", needs="jobs", sql=f"""
select count(*) as sources, cast(sum(total_scraped) as bigint) as total_scraped, cast(sum(new_jobs) as bigint) as new_jobs, cast(sum(duplicates_skipped) as bigint) as duplicates_skipped,
  count(*) filter (source_id % 7 = 3) as failed, round(100.0::double * count(*) filter (source_id % 7 <> 3) / count(*), 2) as success_rate from ({RUN_SQL})
""")
def a4(spark, folder):
    return aggregate.batch_statistics(_runs(spark, folder).withColumn(
        "error", F.when(F.col("source_id") % 7 == 3, F.lit("timeout"))))


@query("a5_daily_trend", needs="jobs", sql="""
select cast(posted_date as date) as day, count(*) as job_count from jobs where posted_date >= date '2001-08-02' - 300 and not archived group by 1
""")
def a5(spark, folder):
    return aggregate.daily_trend(jobs(spark, folder), AS_OF, days=300)


@query("a6_trend_totals", needs="jobs", sql="""
select count(*) as total_jobs, round(count(*) / 300::double, 4) as daily_average from jobs where posted_date >= date '2001-08-02' - 300 and not archived
""")
def a6(spark, folder):
    return aggregate.trend_totals(aggregate.daily_trend(jobs(spark, folder), AS_OF, days=300), 300)


@query("a7_company_hiring", needs="jobs companies", sql="""
select c.name as company, count(*) as total_jobs, round(avg(j.salary_min), 2) as avg_min_salary, round(avg(j.salary_max), 2) as avg_max_salary, max(j.posted_date) as last_job_posted
from jobs j join companies c on j.company_id = c.id where not j.archived group by 1 order by total_jobs desc, company limit 20
""")
def a7(spark, folder):
    return aggregate.company_hiring(jobs(spark, folder), companies(spark, folder))


@query("a8_salary_statistics", needs="jobs", sql="""
select count(*) as total_jobs_with_salary, round(avg(salary_min), 2) as avg_min_salary, round(avg(salary_max), 2) as avg_max_salary, min(salary_min)::double as min_salary,
  max(salary_max)::double as max_salary, round(stddev_samp(salary_min), 2) as salary_std_dev, round((avg(salary_min) + avg(salary_max)) / 2, 2) as midpoint
from jobs where posted_date >= date '2001-08-02' - 900 and not archived and salary_min is not null
""")
def a8(spark, folder):
    return aggregate.salary_statistics(jobs(spark, folder), AS_OF, days=900)


@query("a9_status_counts", needs="jobs", sql="select application_status, count(*) as jobs from jobs group by 1")
def a9(spark, folder):
    return aggregate.status_counts(jobs(spark, folder))


@query("a10_sync_statistics", needs="jobs", sql="""
select count(*) as total_jobs, count(*) filter (not archived) as active_jobs, count(*) filter (archived) as archived_jobs, count(*) filter (favorite) as favorited_jobs,
  count(*) filter (application_status <> 'New') as applied_jobs from jobs
""")
def a10(spark, folder):
    return aggregate.sync_statistics(jobs(spark, folder))


@query("a11_company_rollup", needs="jobs companies", sql="""
select c.id as company_id, c.name, count(j.id) as total_jobs, count(j.id) filter (not j.archived) as active_jobs, max(j.posted_date) as last_job_posted
from companies c left join jobs j on j.company_id = c.id group by 1, 2
""")
def a11(spark, folder):
    return aggregate.company_rollup(companies(spark, folder), jobs(spark, folder))


@query("a12_company_activity", needs="companies", sql="""
select count(*) as total, count(*) filter (active) as active, count(*) filter (not active) as inactive from companies
""")
def a12(spark, folder):
    return aggregate.company_activity(companies(spark, folder))


@query("a13_monthly_costs", needs="views", sql="""
with r as (select event_type as service, sum(value) as c, count(*) as n from views where ts >= timestamp '2024-01-01' and ts < timestamp '2024-02-01' group by 1), t as (select sum(c) as total from r)
select service, round(c, 2) as cost, n as operations, round(total, 2) as total_cost, round(300000.0 - total, 2) as remaining, round(total / 300000.0 * 100, 2) as utilization_percent,
  case when total / 300000.0 >= 1 then 'over_budget' when total / 300000.0 >= 0.8 then 'approaching_limit' when total / 300000.0 >= 0.6 then 'moderate_usage' else 'within_budget' end as budget_status,
  case when total / 300000.0 >= 1 then 'error' when total / 300000.0 >= 0.8 then 'warning' end as alert from r, t
""")
def a13(spark, folder):
    costs = views(spark, folder).selectExpr("ts as timestamp", "event_type as service", "value as cost_usd")
    return aggregate.monthly_costs(costs, datetime(2024, 1, 1), 300_000.0)


DAILY_SQL = "select entity, cast(ts as date) as day, count(*) as views from views where event_type in ('view', 'click') group by 1, 2"


def _looks(spark, folder):
    return views(spark, folder).filter("event_type in ('view', 'click')")


@query("a14_view_totals", needs="views", sql=f"""
select entity, cast(sum(views) as bigint) as total, cast(sum(case when day >= date '2024-01-15' then views else 0 end) as bigint) as since from ({DAILY_SQL}) group by 1
""")
def a14(spark, folder):
    daily = aggregate.running_counters(_looks(spark, folder), "entity")
    return aggregate.view_totals(daily, datetime(2024, 1, 15), "entity")


@query("a15_favorite_totals", needs="views", sql=f"""
with s as (select user_id, entity, arg_max(active, (ts, event_id)) as active, min(ts) as created_at from ({SWITCHES}) group by 1, 2)
select entity, count(*) as total, count(*) filter (cast(created_at as date) >= date '2024-01-15') as since from s where active group by 1
""")
def a15(spark, folder):
    state = lifecycle.switch_state(switches(spark, folder), ["user_id", "entity"])
    return aggregate.favorite_totals(state, datetime(2024, 1, 15), "entity")


@query("a16_views_since", needs="views", sql=f"select entity, cast(sum(views) as bigint) as count from ({DAILY_SQL}) where day >= date '2024-01-20' group by 1")
def a16(spark, folder):
    daily = aggregate.running_counters(_looks(spark, folder), "entity")
    return aggregate.views_since(daily, datetime(2024, 1, 20), "entity")


@query("a17_daily_views_per_entity", needs="views", sql=f"""
with c as ({DAILY_SQL}), k as (select distinct entity from c), d as ({DAYS})
select k.entity, d.day, coalesce(c.views, 0) as views from k cross join d left join c on c.entity = k.entity and c.day = d.day
""")
def a17(spark, folder):
    return series.daily_series(_looks(spark, folder), START, END, keys=["entity"], out="views")


@query("a17_daily_registrations", needs="views", sql=f"""
with c as (select cast(ts as date) as day, count(*) as n from views where event_type = 'signup' group by 1), d as ({DAYS})
select d.day, coalesce(c.n, 0) as user_count from d left join c on c.day = d.day
""")
def a17b(spark, folder):
    return series.daily_series(views(spark, folder).filter("event_type = 'signup'"), START, END, out="user_count")


@query("a17_daily_online_users", needs="views", sql=f"""
with c as (select cast(ts as date) as day, count(distinct user_id) as n from views group by 1), d as ({DAYS})
select d.day, coalesce(c.n, 0) as user_count from d left join c on c.day = d.day
""")
def a17c(spark, folder):
    return series.daily_series(views(spark, folder), START, END, user="user_id", out="user_count")


@query("j8_calendar_gap_fill", needs="views", sql=f"""
with c as (select event_type, cast(ts as date) as day, count(*) as n from views where value > 20 group by 1, 2), k as (select distinct event_type from c), d as ({DAYS})
select k.event_type, d.day, coalesce(c.n, 0) as n from k cross join d left join c on c.event_type = k.event_type and c.day = d.day
""")
def j8(spark, folder):
    counts = views(spark, folder).filter("value > 20").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return series.fill_days(counts, START, END, "n", ["event_type"])


@query("a18_month_dashboard", needs="views", sql="""
with e as (select 'subscribers' as series, entity, ts from views where event_type = 'signup' union all select 'views', entity, ts from views where event_type in ('view', 'click')),
d as (select cast(x as date) as day from (select unnest(generate_series(timestamp '2023-12-30', timestamp '2024-01-30', interval 1 day)) as x)),
k as (select series, entity, count(*) as total_count from e group by 1, 2 having count(*) filter (cast(ts as date) between date '2023-12-30' and date '2024-01-30') > 0),
c as (select series, entity, cast(ts as date) as day, count(*) as n from e group by all)
select k.series, k.entity, d.day, coalesce(c.n, 0) as count, k.total_count from k cross join d left join c on c.series = k.series and c.entity = k.entity and c.day = d.day
""")
def a18(spark, folder):
    return series.month_dashboard(views(spark, folder).filter("event_type = 'signup'"), _looks(spark, folder),
                                  date(2024, 1, 30), "entity")


@query("a18_company_dashboard", needs="views", sql=f"""
with v as (select entity, cast(sum(views) as bigint) as t, cast(sum(case when day >= date '2024-01-10' then views else 0 end) as bigint) as s from ({DAILY_SQL}) group by 1),
st as (select user_id, entity, arg_max(active, (ts, event_id)) as active, min(ts) as created_at from ({SWITCHES}) group by 1, 2),
f as (select entity, count(*) as t, count(*) filter (cast(created_at as date) >= date '2024-01-10') as s from st where active group by 1)
select coalesce(v.entity, f.entity) as entity, coalesce(v.t, 0) as total_views, coalesce(v.s, 0) as month_views, coalesce(f.t, 0) as total_favorites, coalesce(f.s, 0) as month_favorites
from v full join f on v.entity = f.entity
""")
def a18b(spark, folder):
    daily = aggregate.running_counters(_looks(spark, folder), "entity")
    state = lifecycle.switch_state(switches(spark, folder), ["user_id", "entity"])
    return series.company_dashboard(daily, state, datetime(2024, 1, 10), "entity")


@query("a19_running_counters", needs="views", sql=DAILY_SQL)
def a19(spark, folder):
    return aggregate.running_counters(_looks(spark, folder), "entity")


@query("a20_net_subscribers", needs="views", sql=f"""
with e as (select *, lag(active) over (partition by user_id, entity order by ts, event_id) as before from ({SWITCHES}))
select entity, cast(sum(case when active then 1 else -1 end) as bigint) as user_count from e where before is null or before <> active group by 1
""")
def a20(spark, folder):
    dated = switches(spark, folder).withColumn("day", F.to_date("ts"))
    marked = with_previous(dated, ["user_id", "entity"], ["ts", "event_id"], "active", "day")
    changes = marked.filter(F.col("previous").isNull() | (F.col("previous") != F.col("active")))
    return aggregate.net_subscribers(changes, "entity")


@query("a21_unique_viewers", needs="views", sql="""
select entity, cast(ts as date) as day, count(distinct user_id) as viewers from views where event_type in ('view', 'click') group by 1, 2
""")
def a21(spark, folder):
    return aggregate.unique_viewers(_looks(spark, folder), "entity")


@query("a22_hourly_users", needs="views", sql="select date_trunc('hour', ts) as hour, count(distinct user_id) as users from views group by 1")
def a22(spark, folder):
    return aggregate.active_users(views(spark, folder), "hour")


@query("a22_daily_users", needs="views", sql="select date_trunc('day', ts)::timestamp as day, count(distinct user_id) as users from views group by 1")
def a22b(spark, folder):
    return aggregate.active_users(views(spark, folder), "day")


@query("a23_latest_vacancies", needs="vacancies", sql="""
select alias, language, max(date) as latest_vacancy_date, bool_or(remote) as any_remote from vacancies group by 1, 2
""")
def a23(spark, folder):
    return aggregate.latest_vacancies(vacancies(spark, folder), "alias", "language")


@query("a24_language_stats", needs="vacancies", sql="""
select alias, array_to_string(list(language || '=' || cast(d as varchar) order by language), ';') as languages
from (select alias, language, max(date) as d from vacancies group by 1, 2) group by 1
""")
def a24(spark, folder):
    stats = aggregate.language_stats(vacancies(spark, folder))
    shown = F.transform("languages", lambda x: F.concat_ws("=", x["language"], x["max_vacancy_date"].cast("string")))
    return stats.select("alias", F.array_join(shown, ";").alias("languages"))


@query("a25_location_frequency", needs="vacancies", sql="""
select location, count(*) as uses from vacancies where location <> '' group by 1 having count(*) >= 3
""")
def a25(spark, folder):
    return aggregate.location_frequency(vacancies(spark, folder))


@query("a26_category_counts", sql="select lang, count(*) as rows from documents group by 1")
def a26(spark, folder):
    return aggregate.category_counts(table(spark, folder, "documents"), "lang")


@query("a27_scrape_quality", needs="views", sql="""
select count(*) filter (event_type in ('view', 'click')) as processed, count(*) filter (event_type = 'error') as failed, count(*) filter (event_type = 'signup') as missed,
  count(*) filter (event_type = 'purchase') as skipped from views
""")
def a27(spark, folder):
    outcome = (F.when(F.col("event_type").isin("view", "click"), "processed").when(F.col("event_type") == "error", "failed")
               .when(F.col("event_type") == "signup", "missed").otherwise("skipped"))
    return aggregate.scrape_quality(views(spark, folder).withColumn("outcome", outcome))


@query("a28_index_coverage", needs="jobs", sql="""
select count(*) as total_jobs, count(*) filter (id in (select doc_id from labels)) as indexed_jobs,
  round(100.0::double * count(*) filter (id in (select doc_id from labels)) / count(*), 2) as coverage, max(posted_date) filter (id in (select doc_id from labels)) as last_updated from jobs
""")
def a28(spark, folder):
    return aggregate.index_coverage(jobs(spark, folder), table(spark, folder, "labels"))


@query("a29_view_counts", needs="jobs", sql="""
select count(*) as all_jobs, count(*) filter (favorite) as favorites, count(*) filter (application_status = 'Applied') as applied from jobs
""")
def a29(spark, folder):
    return aggregate.view_counts(jobs(spark, folder))


@query("s11_flat_vacancies", needs="vacancies companies", sql="""
select c.id as company_id, v.alias, c.name, v.language, v.id, v.url, v.date from vacancies v join companies c on v.alias = c.alias
""")
def s11(spark, folder):
    # A profile lists a language's vacancies in parts of a range of ids, so that no company is one row.
    nested = (vacancies(spark, folder)
              .groupBy("alias", "language", F.floor(F.col("id") / 1000)).agg(F.collect_list(F.struct("id", "title", "url", "date", "remote")).alias("vacancies"))
              .select("alias", F.array(F.struct("language", "vacancies")).alias("languages")))
    rows = nested.join(companies(spark, folder).select("id", "alias", "name", "ignore"), "alias")
    return flatten_vacancies(rows).select("company_id", "alias", "name", "language", "id", "url", "date")


@query("k6_sitemap", needs="companies vacancies", sql="""
select 'https://jobs.example/rust/companies/' || c.alias as loc, coalesce(cast(max(v.date) as varchar), '2025-01-01') as lastmod
from companies c left join (select * from vacancies where language = 'rust') v on c.alias = v.alias where not c.ignore group by c.alias
""")
def k6(spark, folder):
    return sinks.sitemap_rows(companies(spark, folder).filter("not ignore"),
                              vacancies(spark, folder).filter("language = 'rust'"), "jobs.example", "rust")


@query("k7_alert_rows", needs="jobs", sql="""
select id, 'New ' || case when contains(lower(title), 'intern') then 'Internship' else 'Job' end || ' at ' || company || ':' || chr(10) || '  Job Title: ' || title || chr(10)
  || '  Location: ' || coalesce(location, '?') || chr(10) || '  Link: ' || url || chr(10) || '  Found At: now' || chr(10) || '  Posted At: ' || strftime(posted_date, '%Y-%m-%d') || chr(10) || '  Apply Clicks: N/A' as message,
  case when source_id % 2 = 0 then 'openboard' else 'network' end || case when contains(lower(title), 'intern') then '_internships' else '_jobs' end as route from jobs
""")
def k7(spark, folder):
    rows = jobs(spark, folder).select(
        F.concat(F.when(F.col("source_id") % 2 == 0, "openboard-").otherwise("board-"), F.col("id").cast("string")).alias("key"),
        "company", F.col("title").alias("job_title"), F.coalesce("location", F.lit("?")).alias("location"), "url",
        F.lit("now").alias("found_at"), F.date_format("posted_date", "yyyy-MM-dd").alias("posted_time"),
        F.lit(None).cast("string").alias("apply_clicks"), F.lower("title").contains("intern").alias("is_internship"))
    out = sinks.alert_rows(rows, "openboard", "network")
    return out.select(F.regexp_extract("key", r"-(\d+)$", 1).cast("long").alias("id"), "message", "route")


@query("k5_block_list_rows", needs="docs", sql="""
select key_id, case when length(text) > 150 then substr(text, 1, 150) || '..' else text end as description, '2001-08-02' as post_date from docs
""")
def k5(spark, folder):
    rows = docs(spark, folder).select(
        "key_id", "title", F.lit("c").alias("company"), F.lit(AS_OF).alias("post_date"), F.col("text").alias("description"),
        F.lit("DELETE").alias("status"))
    return sinks.block_list_rows(rows).select("key_id", "description", "post_date")
