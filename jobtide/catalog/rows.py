"""Filters, searches by predicate, quality checks, orders and pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.classify import classify
from ..functions.core import any_word
from ..operators import aggregate, filters, keyed, quality, text_index
from ..session import work_path
from . import base
from .base import companies, docs, heavy_jobs, jobs, query, sources, table, vacancies, views

AS_OF = datetime(2001, 8, 2)
BASIC = ["id", "title", "company", "location", "source_id", "last_seen_at"]


@query("flagship_entry_levels", needs="jobs", sql="""
with leveled as (
  select *, case
    when lower(title) like '%intern%' then 'intern'
    when lower(title) like '%vp%' then 'executive'
    when lower(title) like '%principal%' then 'principal'
    when lower(title) like '%staff%' then 'staff'
    when lower(title) like '%lead%' then 'lead'
    when lower(title) like '%sr%' then 'senior'
    when lower(title) like '%ii%' then 'mid'
    when lower(title) like '%junior%' or lower(title) like '%associate%' then 'entry' end as by_title,
    lower(title || ' ' || coalesce(description, '')) as body from jobs),
hinted as (
  select *, case when by_title is not null then by_title
    when body like '%intern%' then 'intern'
    when body like '%15+ years%' or body like '%20+ years%' or regexp_matches(body, 'executive|director|chief|head of|cto|cio|vp') then 'executive'
    when regexp_matches(body, 'principal|level vii|level 7|l7|distinguished|fellow') then 'principal'
    when regexp_matches(body, 'staff|level vi|level 6|l6|10\\+ years|12\\+ years') then 'staff'
    when regexp_matches(body, 'lead|manager|level v|level 5|l5|8\\+ years|10\\+ years|7-10 years|8-12 years') then 'lead'
    when regexp_matches(body, 'senior|sr|experienced|level iv|level 4|l4|iv|advanced|[5678]\\+ years|5-7 years|5-8 years|5-10 years') then 'senior'
    when regexp_matches(body, 'mid|intermediate|level ii|level 2|level 3|l2|l3|ii|[234]\\+ years|2-5 years|3-5 years|2-4 years|3-6 years|4-6 years') then 'mid'
    when regexp_matches(body, 'junior|jr|entry|associate|graduate|new grad|new-grad|recent grad|college grad|university grad|apprentice|trainee|early career|early-career|no experience required|no experience needed|will train|0-1 years|0-2 years|1-2 years|up to 2 years|level i|level 1|l1|i |ii ') then 'entry'
    end as by_text from leveled),
years as (
  select *, list_min(list_filter(list_transform(
    regexp_extract_all(body, '([0-9]+)\\+?\\s*(?:years?|yrs?)(?:\\s+of)?\\s+(?:experience|exp)', 1) ||
    regexp_extract_all(body, '([0-9]+)\\s*-\\s*[0-9]+\\s*(?:years?|yrs?)(?:\\s+of)?\\s+(?:experience|exp)', 1) ||
    regexp_extract_all(body, 'minimum\\s+(?:of\\s+)?([0-9]+)\\s*(?:years?|yrs?)', 1) ||
    regexp_extract_all(body, 'at\\s+least\\s+([0-9]+)\\s*(?:years?|yrs?)', 1) ||
    regexp_extract_all(body, '([0-9]+)\\s*(?:years?|yrs?)\\s+(?:minimum|min)', 1) ||
    regexp_extract_all(body, 'experience:\\s*([0-9]+)\\+?\\s*(?:years?|yrs?)', 1),
    lambda x: try_cast(x as int)), lambda x: x between 0 and 30)) as y from hinted),
final as (
  select *, coalesce(by_text, case when y <= 2 then 'entry' when y <= 4 then 'mid' when y <= 7 then 'senior'
    when y <= 10 then 'lead' when y is not null then 'staff' else 'unknown' end) as level from years)
select level, count(*) as postings, count(distinct content_hash) as distinct_postings from final
where case when level in ('intern', 'entry') then true
  when level in ('senior', 'lead', 'staff', 'principal', 'executive') then false
  when y is not null then y <= 2 else level = 'unknown' end
group by level
""")
def flagship(spark, folder):
    rows = classify(base.heavy_jobs(spark, folder), location=None)
    friendly = F.col("class.entry_friendly")
    # Counted under a condition: a filter on the struct would be pushed below it
    # and classify every row a second time.
    return rows.groupBy(F.col("class.experience_level").alias("level")).agg(
        F.count_if(friendly).alias("postings"),
        F.count_distinct(F.when(friendly, F.col("content_hash"))).alias("distinct_postings"),
    ).filter("postings > 0")


@query("f1_redistributable_view", needs="jobs sources", sql="""
select j.id, j.title, s.name as source_name, s.base_url as source_url, s.compliance_status
from jobs j join sources s on j.source_id = s.id
where s.compliance_status in ('approved', 'conditional') and j.is_active
""")
def f1(spark, folder):
    return filters.redistributable_jobs(jobs(spark, folder), sources(spark, folder)).select(
        "id", "title", "source_name", "source_url", "compliance_status")


@query("f2_search", needs="jobs sources", sql="""
select j.id, j.title, j.company, j.location, j.source_id, j.last_seen_at
from jobs j join sources s on j.source_id = s.id
where j.is_active and s.compliance_status in ('approved', 'conditional')
  and j.company ilike '%inc%' and j.location ilike '%remote%'
order by j.last_seen_at desc, j.id desc limit 100 offset 20
""")
def f2(spark, folder):
    return filters.search(jobs(spark, folder).select(*BASIC, "is_active"), sources(spark, folder),
                          company="inc", location="remote", limit=100, offset=20).select(*BASIC)


@query("f2_text_search", needs="jobs sources", sql="""
with w as (select *, regexp_extract_all(lower(concat_ws(' ', title, description, company, location)), '[a-z0-9]+') as ws from jobs)
select j.id, j.title, j.company, j.location, j.source_id, j.last_seen_at
from w j join sources s on j.source_id = s.id
where j.is_active and s.compliance_status in ('approved', 'conditional') and j.company ilike '%inc%'
  and list_has_any(ws, ['remote', 'remotes', 'remoted']) and list_has_any(ws, ['position', 'positions', 'positioned'])
order by j.last_seen_at desc, j.id desc limit 100
""")
def f2b(spark, folder):
    """The usual job search with a text query: every word of it, by stem, anywhere in the four fields."""
    rows = heavy_jobs(spark, folder)
    index = text_index.create(rows, work_path(spark, "job-index"))
    return filters.search(jobs(spark, folder).select(*BASIC, "is_active"), sources(spark, folder), company="inc",
                          matching=index.matching("the remote positions"), limit=100).select(*BASIC)


@query("f3_export_filter", needs="jobs sources", sql="""
select j.id, j.company, j.experience_level, j.first_seen_at, s.name as source_name, s.scraper_type as source_type
from jobs j join sources s on j.source_id = s.id
where j.is_active and s.compliance_status in ('approved', 'conditional') and s.scraper_type = 'greenhouse'
  and j.location ilike '%a%' and j.first_seen_at >= timestamp '1996-01-01' and j.first_seen_at <= timestamp '2000-01-01'
""")
def f3(spark, folder):
    return filters.export_select(
        jobs(spark, folder), sources(spark, folder), location="a", source_type="greenhouse",
        posted_after=datetime(1996, 1, 1), posted_before=datetime(2000, 1, 1),
    ).select("id", "company", "experience_level", "first_seen_at", "source_name", "source_type")


@query("f3_export_by_level_and_type", needs="jobs sources", sql="""
select j.id, j.title from jobs j join sources s on j.source_id = s.id
where j.is_active and s.compliance_status in ('approved', 'conditional')
  and j.experience_level = 'mid' and j.job_type = 'contract' and j.remote_type = 'hybrid'
""")
def f3b(spark, folder):
    return filters.export_select(
        jobs(spark, folder), sources(spark, folder), experience_level="mid", job_type="contract",
        remote_type="hybrid").select("id", "title")


@query("f4_approved_sources", needs="sources", sql="""
select id, name from sources where compliance_status in ('approved', 'conditional') and is_active
""")
def f4(spark, folder):
    return filters.approved_sources(sources(spark, folder)).select("id", "name")


@query("f5_source_list", needs="sources", sql="select id, name, is_active from sources where is_active order by name")
def f5(spark, folder):
    return filters.list_sources(sources(spark, folder)).select("id", "name", "is_active")


@query("f6_bulk_lookup", needs="jobs", sql="""
select id, source_id, external_id from jobs where (source_id, external_id) in (
  select o_custkey % 20, 'x' || cast(o_orderkey % 7000 as string) from orders where o_orderpriority = '1-URGENT')
""")
def f6(spark, folder):
    asked = table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'").selectExpr(
        "o_custkey % 20 as source_id", "'x' || cast(o_orderkey % 7000 as string) as external_id")
    return filters.lookup(jobs(spark, folder), asked, ["source_id", "external_id"]).select(
        "id", "source_id", "external_id")


@query("f7_compliance_gate", needs="sources", sql="""
select id, case when compliance_status = 'prohibited' then 'Source is PROHIBITED by terms of service'
  when compliance_status = 'pending_review' then 'Source compliance is pending review'
  when not is_active then 'Source is not active' end as reason,
  compliance_status in ('approved', 'conditional') and is_active as allowed from sources
""")
def f7(spark, folder):
    return filters.compliance(sources(spark, folder)).select("id", "reason", "allowed")


@query("f8_tracker_filter", needs="jobs", sql="""
select id, company, application_status, posted_date from jobs
where not archived and application_status in ('Applied', 'Interested') and favorite
  and posted_date >= timestamp '1996-06-01' and posted_date <= timestamp '2001-01-01'
  and salary_max >= 100000 and salary_min <= 400000
""")
def f8(spark, folder):
    return filters.filter_jobs(
        jobs(spark, folder), statuses=["Applied", "Interested"], favorites_only=True,
        date_from=datetime(1996, 6, 1), date_to=datetime(2001, 1, 1), salary_min=100_000, salary_max=400_000,
    ).select("id", "company", "application_status", "posted_date")


@query("f9_salary_overlap", needs="jobs", sql="""
select id, salary_min, salary_max from jobs where salary_max >= 300000
""")
def f9(spark, folder):
    return jobs(spark, folder).filter(filters.salary_overlap(300_000, 750_000)).select("id", "salary_min", "salary_max")


@query("f10_recently_posted", needs="jobs", sql="""
select id, posted_date from jobs where posted_date >= timestamp '2001-08-02' - interval 30 days and not archived
order by posted_date desc, id desc limit 50
""")
def f10(spark, folder):
    return filters.recent_jobs(jobs(spark, folder), AS_OF, days=30, limit=50).select("id", "posted_date")


@query("f11_changed_since", needs="jobs", sql="""
select id, updated_at from jobs where updated_at > timestamp '2001-06-01'
  and id in (select o_orderkey from orders where o_orderstatus = 'F')
order by updated_at desc, id desc limit 100
""")
def f11(spark, folder):
    wanted = table(spark, folder, "orders").filter("o_orderstatus = 'F'").selectExpr("o_orderkey as id")
    return filters.changed_since(jobs(spark, folder), wanted, datetime(2001, 6, 1), limit=100).select("id", "updated_at")


MASTER_STATUS = base.pick("o_orderkey", "NEW", "APPLIED", "ARCHIVE", "INTERVIEWING", "DELETE", "INTERESTED", "REJECTED", "OLD")
MASTER_REMOTE = base.pick("o_orderkey", "UNKNOWN", "FULLY_REMOTE", "IN_PERSON", "PARTIALLY_REMOTE", "FULLY_REMOTE")
base.TABLES["master"] = f"""select o_orderkey as id, 'k' || cast(o_orderkey as string) as key_id, {MASTER_STATUS} as status,
  {base.JOBS['title']} as title, c_name as company, {base.JOBS['location']} as location, {base.JOBS['description']} as description,
  cast(o_orderdate as timestamp) as post_date, {MASTER_REMOTE} as remoteness, {base.JOBS['link']} as url
  from orders join customer on o_custkey = c_custkey"""


def master(spark, folder):
    rows = table(spark, folder, "orders").join(
        table(spark, folder, "customer").selectExpr("c_custkey as o_custkey", "c_name"), "o_custkey")
    return rows.selectExpr(
        "o_orderkey as id", "'k' || cast(o_orderkey as string) as key_id", f"{MASTER_STATUS} as status",
        f"{base.JOBS['title']} as title", "c_name as company", f"{base.JOBS['location']} as location",
        f"{base.JOBS['description']} as description", "cast(o_orderdate as timestamp) as post_date",
        f"{MASTER_REMOTE} as remoteness", f"{base.JOBS['link']} as url")


@query("f12_reject_filter", needs="master", sql="""
select id, status, remoteness from master where status not in ('DELETE', 'ARCHIVE', 'REJECTED', 'OLD')
  and company not in ('Customer#000000007', 'Customer#000000010')
  and post_date >= timestamp '1996-01-01'
  and key_id not in (select 'k' || cast(l_orderkey as string) from lineitem where l_returnflag = 'R' and l_linenumber = 1)
  and key_id not in (select 'k' || cast(l_orderkey as string) from lineitem where l_quantity > 49)
  and (remoteness = 'UNKNOWN' or remoteness = 'FULLY_REMOTE')
""")
def f12(spark, folder):
    lines = table(spark, folder, "lineitem")
    key = "'k' || cast(l_orderkey as string) as key_id"
    return filters.job_filter(
        master(spark, folder), blocked_companies=["Customer#000000007", "Customer#000000010"],
        oldest=datetime(1996, 1, 1),
        block_list=lines.filter("l_returnflag = 'R' and l_linenumber = 1").selectExpr(key),
        duplicates=lines.filter("l_quantity > 49").selectExpr(key), remoteness="FULLY_REMOTE",
    ).select("id", "status", "remoteness")


@query("f12_reject_reasons", needs="master", sql="""
select case when status in ('DELETE', 'ARCHIVE', 'REJECTED', 'OLD') then 'status'
  when company in ('Customer#000000007') then 'company' when post_date < timestamp '1996-01-01' then 'age'
  when remoteness not in ('UNKNOWN', 'IN_PERSON') then 'remoteness' end as reject_reason, count(*) as jobs
from master group by 1
""")
def f12b(spark, folder):
    told = filters.reject_reason(master(spark, folder), blocked_companies=["Customer#000000007"],
                                 oldest=datetime(1996, 1, 1), remoteness="IN_PERSON")
    return told.groupBy("reject_reason").agg(F.count("*").alias("jobs"))


@query("f13_by_location_and_job_type", needs="jobs", sql="""
select id from jobs where remote_type = 'remote' and job_type = 'contract'
""")
def f13(spark, folder):
    rows = jobs(spark, folder).withColumnRenamed("remote_type", "location_type")
    return filters.by_kind(rows, "remote", "contract").select("id")


@query("f14_relevant_titles", needs="jobs", sql=f"""
select id, title from jobs where regexp_matches(title, '(?i)\\b(?:{any_word(fixed.RELEVANT_PHRASES)})\\b')
""")
def f14(spark, folder):
    return filters.relevant_jobs(jobs(spark, folder)).select("id", "title")


@query("f15_fresh_board_rows", needs="jobs", sql="""
select title as job_title, company, location, 'https://board.example/p/' || cast(id as string) || '/' || lower(replace(title, ' ', '-')) as url,
  'openboard-' || cast(id as string) as key, cast(epoch(posted_date) as bigint) as updated_date
from (select id, title, company, coalesce(location, 'Unknown Location') as location, posted_date from jobs)
where posted_date >= timestamp '2001-08-02' - interval 14 days
""")
def f15(spark, folder):
    rows = jobs(spark, folder).select(
        F.col("id").cast("string").alias("id"), "title", F.col("company").alias("company_name"),
        F.array("location", F.lit("elsewhere")).alias("locations"),
        F.unix_timestamp("posted_date").alias("updated_date"))
    return filters.fresh_board_rows(rows, 996_710_400, "openboard", "https://board.example/p/")


@query("f16_companies_for_language", needs="companies codes vacancies", sql="""
with stats as (select alias, max(date) as latest, bool_or(remote) as remote, count(*) as n from vacancies
  where language = 'rust' group by alias)
select c.alias, k.id, s.latest as latest_vacancy_date, c.remote or coalesce(s.remote, false) as remote, coalesce(s.n, 0) as vacancies
from companies c join codes k on c.alias = k.alias left join stats s on c.alias = s.alias
where not c.ignore and (coalesce(s.n, 0) > 0 or c.foundation_member)
""")
def f16(spark, folder):
    return filters.companies_for_language(
        companies(spark, folder), vacancies(spark, folder), base.codes(spark, folder), "rust", members_too=True,
    ).select("alias", "id", "latest_vacancy_date", "remote", "vacancies")


@query("f17_missing_profiles", needs="companies vacancies", sql="""
select c.id, c.alias, max(v.date) as latest_vacancy_date from companies c join vacancies v on c.alias = v.alias
where not c.ignore and c.employees in ('10K+', '5K-10K', '1K-5K', '501-1K', '201-500', '51-200')
  and (coalesce(c.careers, '') = '' or coalesce(c.about, '') = '' or coalesce(c.blog, '') = '')
group by c.id, c.alias
""")
def f17(spark, folder):
    return filters.missing_profiles(companies(spark, folder), vacancies(spark, folder),
                                    filters.PROFILE_FIELDS["web"]).select("id", "alias", "latest_vacancy_date")


@query("f18_small_companies", needs="companies", sql="""
select id, employees from companies where employees not in ('10K+', '5K-10K', '1K-5K', '501-1K', '201-500', '51-200')
""")
def f18(spark, folder):
    return companies(spark, folder).filter(filters.small_company()).select("id", "employees")


@query("f19_active_companies", needs="companies", sql="select name from companies where active")
def f19(spark, folder):
    return filters.active_companies(companies(spark, folder))


@query("f21_company_extract", needs="companies vacancies", sql="""
select name, website, github from companies c where not ignore and github_verified and
  (alias in (select alias from vacancies where language = 'rust') or foundation_member)
""")
def f21(spark, folder):
    rows = companies(spark, folder).withColumn(
        "sync_sources", F.when(F.col("foundation_member"), F.array(F.lit("rust"))).otherwise(F.array(F.lit("none"))))
    return filters.company_extract(rows, vacancies(spark, folder), "rust", "rust", verified=True)


@query("f22_board_rows_for_beginners", needs="jobs", sql="""
select id, title as job_title from jobs where id % 10 <> 0 and company not like '%Corp%'
  and (regexp_matches(lower(title), '\\bintern\\b') or (
    not regexp_matches(lower(title), '\\b(senior|head|sr|staff|lead|manager|principal|expert|vp|director|chief|phd)\\b')
    and (regexp_matches(lower(coalesce(description, '')), '\\b0-[0-9]*\\+?\\s*years?')
      or coalesce(list_min(list_transform(
        regexp_extract_all(regexp_replace(lower(coalesce(description, '')), '<[^>]+>', ' ', 'g'), '([0-9]+)-[0-9]*\\+?\\s*years?', 1) ||
        regexp_extract_all(regexp_replace(lower(coalesce(description, '')), '<[^>]+>', ' ', 'g'), '([0-9]+)\\s*\\+?\\s*years?', 1),
        lambda x: cast(x as bigint))), 0) <= 1)))
""")
def f22(spark, folder):
    rows = jobs(spark, folder).selectExpr("id", "title as job_title", "company", "description", "id % 10 = 0 as reposted")
    return filters.entry_level_board_rows(rows, aggregator="Corp").select("id", "job_title")


@query("f23_sources_in_category", needs="sources", sql="select id, category from sources where lower(category) = 'api'")
def f23(spark, folder):
    return filters.sources_in_category(sources(spark, folder), "API").select("id", "category")


# Quality checks.

@query("q1_job_fields", needs="jobs", sql="""
select id, unnest(list_filter([case when length(company) > 255 then 'company too long' end,
  case when coalesce(experience_level, '') <> '' and length(experience_level) > 50 then 'experience_level too long' end,
  case when length(salary_currency) > 3 then 'salary_currency too long' end,
  case when coalesce(url, '') = '' then 'url missing' end], lambda x: x is not null)) as problem from (
  select * replace (case when id % 50 = 0 then 'USDT' else salary_currency end as salary_currency,
    case when id % 70 = 0 then null else url end as url) from jobs)
""")
def q1(spark, folder):
    rows = jobs(spark, folder).withColumns({
        "salary_currency": F.when(F.col("id") % 50 == 0, "USDT").otherwise(F.col("salary_currency")),
        "url": F.when(F.col("id") % 70 != 0, F.col("url"))})
    return quality.job_field_checks(rows)


@query("q1_source_fields", needs="sources", sql="""
select id, unnest(list_filter([case when rate_limit_requests not between 1 and 1000 then 'rate limit requests out of range' end,
  case when rate_limit_period not between 1 and 3600 then 'rate limit period out of range' end], lambda x: x is not null)) as problem from sources
""")
def q1b(spark, folder):
    return quality.source_field_checks(sources(spark, folder))


@query("q2_allowed_values", needs="jobs", sql="""
select id, 'experience_level unknown' as problem from jobs where experience_level not in ('entry', 'mid', 'senior', 'lead', 'executive')
""")
def q2(spark, folder):
    return quality.allowed_value_checks(jobs(spark, folder))


@query("q2_repeated_keys", needs="jobs", sql="""
select source_id, external_id, count(*) as uses from jobs group by all having count(*) > 1
""")
def q2b(spark, folder):
    return quality.repeated_keys(jobs(spark, folder), ["source_id", "external_id"])


@query("q2_orphans", needs="jobs sources", sql="""
select id, source_id from jobs where source_id not in (select id from sources where compliance_status <> 'prohibited')
""")
def q2c(spark, folder):
    kept = sources(spark, folder).filter("compliance_status <> 'prohibited'")
    return quality.orphans(jobs(spark, folder), kept).select("id", "source_id")


@query("q3_valid_master_rows", needs="master", sql="""
select id from master where length(description) >= 40 and key_id <> '' and title <> '' and company <> '' and url <> ''
""")
def q3(spark, folder):
    return quality.valid_master_rows(master(spark, folder), least_description=40).select("id")


@query("q4_tracker_rows", needs="jobs", sql="""
select id, 'content hash not 32 long' as problem from jobs
union all select id, 'link blank' from jobs where id % 41 = 0
""")
def q4(spark, folder):
    rows = jobs(spark, folder).withColumn("link", F.when(F.col("id") % 41 == 0, " ").otherwise(F.col("link")))
    return quality.tracker_row_checks(rows)


@query("q4_ordered_salary", needs="jobs", sql="""
select id, least(salary_max, salary_min) as salary_min, greatest(salary_max, salary_min) as salary_max, trim(title) as title from jobs
""")
def q4b(spark, folder):
    rows = jobs(spark, folder).select("id", "title", "link", F.col("salary_max").alias("salary_min"),
                                      F.col("salary_min").alias("salary_max"))
    return quality.ordered_salary(rows).select("id", "salary_min", "salary_max", "title")


@query("q5_vacancy_integrity", needs="vacancies", sql="""
select id, 'title empty' as problem from vacancies where title = ''
union all select id, 'url empty' from vacancies where url = ''
""")
def q5(spark, folder):
    return quality.vacancy_checks(vacancies(spark, folder))


@query("q6_company_integrity", needs="companies", sql="""
select id, 'profile_name empty' as problem from companies where profile_name = ''
union all select id, 'website not a URL' from companies where website like '%\\%zz%' escape '\\'
""")
def q6(spark, folder):
    return quality.company_checks(companies(spark, folder))


@query("q6_uncoded_aliases", needs="companies codes", sql="""
select alias from companies where foundation_member and alias not in (select alias from codes)
""")
def q6b(spark, folder):
    mapped = companies(spark, folder).filter("foundation_member").select("alias")
    return quality.uncoded_aliases(mapped, base.codes(spark, folder))


@query("q7_extracted_postings", needs="jobs", sql="""
select id, problem from (
  select id, unnest(list_filter([case when trim(coalesce(location, '')) = '' then 'location blank' end,
    case when trim(coalesce(description, '')) = '' then 'description blank' end,
    case when length(description) < 50 then 'description too short' end], lambda x: x is not null)) as problem from jobs)
""")
def q7(spark, folder):
    rows = jobs(spark, folder).select(
        "id", "title", "company", "location", "description", "url", F.lit("x").alias("salary_text"),
        F.col("job_type").alias("employment_type"), F.col("posted_date").cast("string").alias("posted_date"))
    return quality.extracted_posting_checks(rows)


@query("q7_repaired_urls", needs="companies", sql="""
select id, case when about is null or about = '' or about like 'https://us%' then about else 'https://' || replace(about, 'https://', '') end as about from companies
""")
def q7b(spark, folder):
    rows = companies(spark, folder).withColumn(
        "about", F.when(F.col("about").startswith("https://us"), F.col("about")).otherwise(
            F.replace("about", F.lit("https://"), F.lit(""))))
    return rows.select("id", quality.repaired_url("about").alias("about"))


# Orders, pages and keyed rows.

@query("w1_keep_first", needs="jobs", sql="""
select external_id, id, title from (select *, row_number() over (partition by external_id order by id) as rn from jobs) where rn = 1
""")
def w1(spark, folder):
    rows = jobs(spark, folder).select("external_id", "id", "title")
    return keyed.keep_first(rows, ["external_id"], ["id"])


@query("w1_keep_last", needs="views", sql="""
select event_type, entity, event_id, value from (select *, row_number() over (partition by event_type, entity order by ts desc, event_id desc) as rn from views) where rn = 1
""")
def w1b(spark, folder):
    rows = views(spark, folder).select("event_type", "entity", "event_id", "value", "ts")
    return keyed.keep_last(rows, ["event_type", "entity"], ["ts", "event_id"]).drop("ts")


@query("w2_best_match", needs="views", sql="""
select user_id, entity, value from (select user_id, entity, value, row_number() over (
  partition by user_id order by value desc, entity) as rn from (select user_id, entity, max(value) as value from views group by 1, 2)) where rn = 1
""")
def w2(spark, folder):
    scores = views(spark, folder).groupBy("user_id", "entity").agg(F.max("value").alias("value"))
    return keyed.best_match(scores, "user_id", "entity", "value")


@query("w3_newest_first", needs="jobs", sql="""
select id, application_date from jobs order by application_date desc nulls last, id desc
""")
def w3(spark, folder):
    return keyed.newest_first(jobs(spark, folder).select("id", "application_date"), "application_date")


@query("w4_pinned_first", needs="companies", sql="""
select name, pinned and github_verified as pinned from companies order by 2 desc, id desc
""")
def w4(spark, folder):
    rows = companies(spark, folder)
    pinned = F.col("pinned") & F.col("github_verified")
    return keyed.pinned_first(rows, pinned, [F.col("id").desc()]).select("name", pinned.alias("pinned"))


@query("w5_top_k", needs="jobs", sql="select id, salary_max from jobs order by salary_max desc nulls last, id limit 256")
def w5(spark, folder):
    rows = jobs(spark, folder).select("id", "salary_max")
    return keyed.top_k(rows, [F.col("salary_max").desc_nulls_last(), F.col("id")], 256)


@query("w6_page", needs="jobs", sql="select id, posted_date from jobs order by posted_date desc, id desc limit 25 offset 50")
def w6(spark, folder):
    rows = jobs(spark, folder).select("id", "posted_date")
    return keyed.page(rows, [F.col("posted_date").desc(), F.col("id").desc()], limit=25, offset=50)


@query("w6_page_after_row", needs="jobs", sql="""
select id, posted_date from jobs where posted_date < timestamp '2000-03-01' or (posted_date = timestamp '2000-03-01' and id < 9000)
order by posted_date desc, id desc limit 25
""")
def w6b(spark, folder):
    rows = jobs(spark, folder).select("id", "posted_date")
    return keyed.page_after(rows, "posted_date", "id", (datetime(2000, 3, 1), 9000), 25)


@query("w7_latest_per_email", needs="views", sql="""
select 'u' || cast(user_id as string) || '@example.com' as email, max(event_id) as event_id,
  arg_max(event_type, event_id) as event_type from views group by 1
""")
def w7(spark, folder):
    rows = views(spark, folder).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email"),
        "event_id", "event_type")
    return keyed.keep_last(rows, ["email"], ["event_id"])


@query("w8_latest_profiles", needs="views", sql="""
select event_id, user_id, event_type from views where event_type in ('signup', 'error') order by event_id desc limit 100
""")
def w8(spark, folder):
    rows = views(spark, folder).filter(F.col("event_type").isin("signup", "error"))
    return keyed.top_k(rows.select("event_id", "user_id", "event_type"), [F.col("event_id").desc()], 100)


@query("w9_existence", needs="companies vacancies", sql="""
select alias from companies c where exists (select 1 from vacancies v where v.alias = c.alias and v.language = 'scala')
""")
def w9(spark, folder):
    found = vacancies(spark, folder).filter("language = 'scala'").select("alias")
    return companies(spark, folder).select("alias").join(found, "alias", "left_semi")


@query("w10_union_of_sources", needs="jobs docs", sql="""
select kind, count(*) as rows from (select 'jobs' as kind, id, title from jobs union all select 'docs', id, title from docs) group by kind
""")
def w10(spark, folder):
    left = jobs(spark, folder).select(F.lit("jobs").alias("kind"), "id", "title")
    right = docs(spark, folder).select("title", "id", F.lit("docs").alias("kind"))
    return aggregate.category_counts(left.unionByName(right), "kind")


@query("w11_key_difference", needs="jobs", sql="""
select link from jobs where not archived and link not in (select 'https://jobs.example/' || cast(l_orderkey as string) from lineitem where l_linenumber = 5)
""")
def w11(spark, folder):
    current = table(spark, folder, "lineitem").filter("l_linenumber = 5").selectExpr(
        "'https://jobs.example/' || cast(l_orderkey as string) as link")
    stored = jobs(spark, folder).filter("not archived").select("link")
    return stored.join(current, "link", "left_anti")
