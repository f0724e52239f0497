"""Landed JSON, HTML and Markdown built from the tables, read into postings.

The landed text is made by Spark from the given tables; the SQL twin works on the
tables directly.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..plans import compile as site_plan
from ..plans.export import export_rows
from ..session import work_path
from ..sources import boards, files, lists, sinks, sites
from .base import heavy_jobs as jobs
from .base import query, sources, table
from .rows import master
from .texts import TAGLESS

NOW = datetime(2001, 8, 2)
J = F.to_json


@query("s1_greenhouse", needs="jobs", sql="""
select source_id, cast(id as varchar) as external_id, trim(title) as title, 'board' as company, coalesce(location, null) as location, coalesce(description, '') as description,
  case when id % 4 = 0 then 'https://boards.greenhouse.io/b' || cast(source_id as varchar) || '/jobs/' || cast(id as varchar) else url end as url, job_type, experience_level, null as remote_type from jobs
""")
def s1(spark, folder):
    j = jobs(spark, folder)
    posting = F.struct(
        F.col("id"), "title", F.when(F.col("id") % 4 != 0, F.col("url")).alias("absolute_url"), F.col("description").alias("content"),
        F.struct(F.col("location").alias("name")).alias("location"),
        F.array(F.struct(F.lit("Employment Type").alias("name"), F.col("job_type").alias("value")),
                F.struct(F.lit("Seniority").alias("name"), F.col("experience_level").alias("value")),
                F.struct(F.lit("Other").alias("name"), F.lit("x").alias("value"))).alias("metadata"))
    raw = j.select("source_id", F.lit("board").alias("company"), F.concat(F.lit("b"), F.col("source_id").cast("string")).alias("board"),
                   J(F.struct(F.array(posting).alias("jobs"))).alias("value"))
    return boards.ingest_greenhouse(raw)


@query("s2_lever", needs="jobs", sql="""
select source_id, cast(id as varchar) as external_id, trim(title) as title, 'lev' as company, nullif(location, '') as location,
  coalesce(nullif(description, '') || chr(10), '') || chr(10) || 'Needs:' || chr(10) || cast(id % 7 as varchar) || ' things' as description,
  case when id % 3 = 0 then 'https://apply.example' else link end as url, case when job_type = 'internship' then 'internship' else job_type end as job_type,
  null as experience_level, null as remote_type from jobs
""")
def s2(spark, folder):
    raw = jobs(spark, folder).select("source_id", F.lit("lev").alias("company"), J(F.struct(
        F.col("id").cast("string").alias("id"), F.col("title").alias("text"),
        F.when(F.col("id") % 3 == 0, "").otherwise(F.col("link")).alias("hostedUrl"), F.lit("https://apply.example").alias("applyUrl"),
        F.col("description").alias("descriptionPlain"),
        F.struct("location", F.lit("team").alias("team"), F.initcap("job_type").alias("commitment")).alias("categories"),
        F.array(F.struct(F.lit("Needs").alias("text"), F.concat((F.col("id") % 7).cast("string"), F.lit(" things")).alias("content")),
                F.struct(F.lit("Empty").alias("text"), F.lit("").alias("content"))).alias("lists"))).alias("value"))
    return boards.ingest_lever(raw)


@query("s3_ashby", needs="jobs", sql="""
with p as (select *, case id % 5 when 0 then coalesce(nullif(location, ''), 'Office ' || cast(source_id as varchar)) when 1 then 'Town, Land' when 2 then 'Office ' || cast(source_id as varchar)
  when 3 then 'Remote hub' else 'Object place' end as place from jobs)
select source_id, cast(id as varchar) as external_id, trim(title) as title, 'ash' as company, place as location, coalesce(description, '<p>html</p>') as description,
  case when id % 2 = 0 then link else 'https://jobs.ashbyhq.com/ash/' || cast(id as varchar) end as url,
  case id % 4 when 0 then 'full-time' when 1 then 'internship' when 2 then 'fixed-term' end as job_type, null as experience_level,
  case when id % 7 = 0 then 'remote' when id % 7 = 1 then case when id % 3 = 0 then 'onsite' end when contains(lower(place), 'remote') then 'remote' when id % 3 = 0 then 'onsite' end as remote_type from p
""")
def s3(spark, folder):
    k = F.col("id")
    raw = jobs(spark, folder).select("source_id", F.lit("ash").alias("company"), F.lit("ash").alias("slug"), J(F.struct(
        k, "title", F.when(k % 2 == 0, F.col("link")).alias("jobUrl"), F.when(k % 5 == 0, F.col("location")).alias("location"),
        F.when(k % 5 == 1, F.struct(F.lit("Town").alias("addressLocality"), F.lit(None).cast("string").alias("addressRegion"),
                                    F.lit("Land").alias("addressCountry"))).alias("address"),
        F.when(k % 5 <= 2, F.concat(F.lit("Office "), F.col("source_id").cast("string"))).alias("locationName"),
        F.when(k % 5 == 3, F.array(F.lit("Remote hub"), F.lit("b"))).when(k % 5 == 4, F.array(F.lit('{"name": "Object place"}'))).alias("locations"),
        F.when(k % 7 == 0, True).when(k % 7 == 1, False).alias("isRemote"), (k % 3 == 0).alias("isOnsite"),
        F.col("description").alias("descriptionPlain"), F.lit("<p>html</p>").alias("descriptionHtml"),
        F.when(k % 4 == 0, "FullTime").when(k % 4 == 1, "Intern").when(k % 4 == 2, "Fixed Term").alias("employmentType"))).alias("value"))
    return boards.ingest_ashby(raw)


@query("s4_amazon", needs="jobs", sql="""
with t as (select *, lower(title) as t from jobs)
select source_id, cast(id as varchar) as external_id, trim(title) as title, 'Amazon' as company, case when id % 2 = 0 then 'Norm Place' when coalesce(location, '') <> '' then location else 'City, US' end as location,
  'Short text' || coalesce(chr(10) || chr(10) || description, '') || chr(10) || chr(10) || '## Basic Qualifications' || chr(10) || 'BS' || case when id % 5 = 0 then chr(10) || chr(10) || '## Preferred Qualifications' || chr(10) || 'MS' else '' end as description,
  'https://www.amazon.jobs/en/jobs/' || cast(id as varchar) as url, job_type,
  case when contains(t, 'intern') or id % 31 = 0 then 'intern' when contains(t, 'entry') or contains(t, 'new grad') or id % 29 = 0 then 'entry'
    when contains(t, 'junior') or contains(t, 'jr') then 'entry' when contains(t, 'senior') or contains(t, 'sr') then 'senior'
    when contains(t, 'principal') or contains(t, 'staff') then 'lead' when contains(t, 'director') or contains(t, 'vp') then 'executive' when id % 5 = 0 then 'senior' end as experience_level,
  case id % 4 when 0 then 'remote' when 1 then 'hybrid' when 2 then 'onsite' end as remote_type from t
""")
def s4(spark, folder):
    k = F.col("id")
    kind = F.when(k % 4 == 0, "Remote").when(k % 4 == 1, "HYBRID").when(k % 4 == 2, "ONSITE").otherwise("OTHER")
    raw = jobs(spark, folder).select("source_id", J(F.struct(
        k, "title", "location", F.when(k % 2 == 0, "Norm Place").alias("normalized_location"), F.lit("City").alias("city"),
        F.lit("US").alias("country_code"), "description", F.lit("Short text").alias("description_short"),
        F.lit("BS").alias("basic_qualifications"), F.when(k % 5 == 0, "MS").alias("preferred_qualifications"),
        F.col("job_type").alias("job_schedule_type"),
        F.array(F.lit("not json"), F.to_json(F.struct(F.lit("NONE").alias("type"))), F.to_json(F.struct(kind.alias("type")))).alias("locations"),
        (k % 31 == 0).alias("is_intern"), (k % 29 == 0).alias("university_job"), (k % 5 == 0).alias("is_manager"))).alias("value"))
    return boards.ingest_amazon(raw)


SITE_SHOWN = ["id", "site", "job_url", "title", "company", "location", "date_posted", "job_type", "interval", "min_amount", "max_amount", "currency", "is_remote"]


def _indeed_raw(spark, folder):
    k = F.col("id")
    pay = F.struct(F.lit("YEAR").alias("unitOfWork"), F.struct(F.col("salary_min").alias("min"), F.col("salary_max").alias("max")).alias("range"))
    details = F.struct(F.array(F.lit("1 Road")).alias("addresses"), F.lit("Iv1SOFTWARE_TOOLS").alias("industry"),
                       F.lit("51 to 200").alias("employeesLocalizedLabel"), F.lit("$1M").alias("revenueLocalizedLabel"), F.lit("brief").alias("briefDescription"))
    dossier = F.struct(F.struct(F.lit("https://corp.example").alias("corporateWebsite")).alias("links"),
                       F.struct(F.lit("logo").alias("squareLogoUrl")).alias("images"), details.alias("employerDetails"))
    return jobs(spark, folder).select(F.col("seq"), J(F.struct(
        (k % 12000).cast("string").alias("key"), "title", F.struct(F.col("description").alias("html")).alias("description"),
        F.unix_millis("posted_date").alias("datePublished"),
        F.array(F.struct(F.lit("Full-time").alias("label")), F.struct(F.lit("Part time").alias("label")), F.struct(F.lit("Dental").alias("label"))).alias("attributes"),
        F.struct(F.lit("Austin").alias("city"), F.lit("TX").alias("admin1Code"), F.lit("US").alias("countryCode"),
                 F.struct(F.col("location").alias("long")).alias("formatted")).alias("location"),
        F.struct(F.when(F.col("salary_min").isNotNull(), pay).alias("baseSalary"), F.lit("USD").alias("currencyCode")).alias("compensation"),
        F.struct(F.lit("https://direct.example").alias("viewJobUrl")).alias("recruit"),
        F.struct(F.col("company").alias("name"), F.lit("/cmp/x").alias("relativeCompanyPageUrl"), dossier.alias("dossier")).alias("employer"))).alias("value"))


@query("s15_indeed", needs="jobs", sql="""
with f as (select * from (select *, row_number() over (partition by id % 12000 order by id) as rn from jobs) where rn = 1)
select 'in-' || cast(id % 12000 as varchar) as id, 'indeed' as site, 'https://www.indeed.com/viewjob?jk=' || cast(id % 12000 as varchar) as job_url, title, company, 'Austin, TX, USA' as location,
  cast(posted_date as date) as date_posted, 'fulltime, parttime' as job_type, case when salary_min is not null then 'yearly' end as interval, salary_min::double as min_amount, salary_max::double as max_amount,
  case when salary_min is not null then 'USD' end as currency, regexp_matches(lower(coalesce(description, '') || ' ' || coalesce(location, '')), 'remote|work from home|wfh') as is_remote,
  'Software Tools' as company_industry from f
""")
def s15(spark, folder):
    return sites.ingest_board(_indeed_raw(spark, folder), "indeed", NOW).select(*SITE_SHOWN, "company_industry")


def _zip_raw(spark, folder):
    k = F.col("id")
    return jobs(spark, folder).select("seq", J(F.struct(
        k.cast("string").alias("listing_key"), F.col("title").alias("name"), F.col("description").alias("job_description"), F.lit("paid").alias("buyer_type"),
        F.struct(F.col("company").alias("name")).alias("hiring_company"), F.when(k % 2 == 0, "US").otherwise("CA").alias("job_country"),
        F.lit("Reno").alias("job_city"), F.lit("NV").alias("job_state"), F.lit("FULL_TIME").alias("employment_type"),
        F.date_format("posted_date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("posted_time"), F.lit("annual").alias("compensation_interval"),
        F.col("salary_min").alias("compensation_min"), F.col("salary_max").alias("compensation_max"), F.lit("USD").alias("compensation_currency"))).alias("value"))


@query("s15_ziprecruiter", needs="jobs", sql="""
select 'zr-' || cast(id as varchar) as id, 'zip_recruiter' as site, 'https://www.ziprecruiter.com/jobs//j?lvk=' || cast(id as varchar) as job_url, title, company,
  case when id % 2 = 0 then 'Reno, NV, USA' else 'Reno, NV, Canada' end as location, cast(posted_date as date) as date_posted, 'fulltime' as job_type, 'yearly' as interval,
  salary_min::double as min_amount, salary_max::double as max_amount, 'USD' as currency, null as is_remote,
  nullif(array_to_string(regexp_extract_all(coalesce(description, ''), '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}'), ', '), '') as emails from jobs
""")
def s15b(spark, folder):
    return sites.ingest_board(_zip_raw(spark, folder), "zip_recruiter", NOW).select(*SITE_SHOWN, "emails")


def _glassdoor_raw(spark, folder):
    k = F.col("id")
    return jobs(spark, folder).select("seq", J(F.struct(F.struct(
        F.struct(k.alias("listingId"), F.col("title").alias("jobTitleText")).alias("job"),
        F.struct(F.col("company").alias("employerNameFromSearch"), F.struct(F.col("company_id").alias("id")).alias("employer"),
                 F.lit("Reno, NV").alias("locationName"), F.when(k % 4 == 0, "S").otherwise("C").alias("locationType"),
                 (k % 30).cast("int").alias("ageInDays"), F.when(k % 2 == 0, "ANNUAL").otherwise("HOURLY").alias("payPeriod"),
                 F.struct((F.col("salary_min") + 0.5).alias("p10"), (F.col("salary_max") + 0.5).alias("p90")).alias("payPeriodAdjustedPay"),
                 F.lit("PREMIUM").alias("adOrderSponsorshipLevel")).alias("header"),
        F.struct(F.lit("logo").alias("squareLogoUrl")).alias("overview")).alias("jobview"))).alias("value"))


@query("s15_glassdoor", needs="jobs", sql="""
select 'gd-' || cast(id as varchar) as id, 'glassdoor' as site, 'https://www.glassdoor.com/job-listing/j?jl=' || cast(id as varchar) as job_url, title, company,
  case when id % 4 <> 0 then 'Reno, NV' end as location, date '2001-08-02' - cast(id % 30 as int) as date_posted, null as job_type,
  case when salary_min is not null then case when id % 2 = 0 then 'yearly' else 'hourly' end end as interval, salary_min::double as min_amount, salary_max::double as max_amount,
  case when salary_min is not null then 'USD' end as currency, id % 4 = 0 as is_remote, 'https://www.glassdoor.com/Overview/W-EI_IE' || cast(company_id as varchar) || '.htm' as company_url from jobs
""")
def s15c(spark, folder):
    return sites.ingest_board(_glassdoor_raw(spark, folder), "glassdoor", NOW).select(*SITE_SHOWN, "company_url")


def _naukri_raw(spark, folder):
    k = F.col("id")
    place = F.struct(F.lit("location").alias("type"), F.when(k % 3 == 0, "Pune, Hybrid").otherwise("Pune").alias("label"))
    pay = F.struct(F.lit("salary").alias("type"), F.when(k % 2 == 0, F.concat((k % 20).cast("string"), F.lit("-25 Lacs P.A."))).otherwise("Not disclosed").alias("label"))
    return jobs(spark, folder).select("seq", J(F.struct(
        k.alias("jobId"), "title", F.col("company").alias("companyName"), F.array(place, pay).alias("placeholders"),
        F.when(k % 2 == 0, F.concat((k % 9).cast("string"), F.lit(" Days Ago"))).alias("footerPlaceholderLabel"), F.unix_millis("posted_date").alias("createdDate"),
        F.col("description").alias("jobDescription"), F.lit("a,b").alias("tagsAndSkills"), F.lit("1-3 Yrs").alias("experienceText"),
        F.struct(F.lit("4.5").alias("AggregateRating"), F.lit(7).alias("ReviewsCount")).alias("ambitionBoxData"), F.lit(2).alias("vacancy"))).alias("value"))


@query("s15_naukri", needs="jobs", sql="""
select 'nk-' || cast(id as varchar) as id, 'naukri' as site, 'https://www.naukri.com/job/' || cast(id as varchar) as job_url, title, company,
  case when id % 3 = 0 then 'Pune, Hybrid, India' else 'Pune, India' end as location, case when id % 2 = 0 then date '2001-08-02' - cast(id % 9 as int) else cast(posted_date as date) end as date_posted,
  null as job_type, null as interval, case when id % 2 = 0 then 100000.0::double * (id % 20) end as min_amount, case when id % 2 = 0 then 2500000.0::double end as max_amount, case when id % 2 = 0 then 'INR' end as currency,
  regexp_matches(lower(title || ' ' || coalesce(description, '')), 'remote|work from home|wfh') as is_remote,
  case when id % 3 = 0 or contains(lower(coalesce(description, '')), 'hybrid') then 'Hybrid' when contains(lower(coalesce(description, '')), 'remote') then 'Remote' else 'Work from office' end as work_from_home_type,
  4.5::double as company_rating, 'a, b' as skills from jobs
""")
def s15d(spark, folder):
    return sites.ingest_board(_naukri_raw(spark, folder), "naukri", NOW).select(*SITE_SHOWN, "work_from_home_type", "company_rating", "skills")


def _google_raw(spark, folder):
    k = F.col("id")
    cells = [F.lit(None).cast("string")] * 29
    cells[0], cells[1] = F.col("title"), F.col("company")
    cells[2] = F.when(k % 2 == 0, "Reno, NV, usa").otherwise("Reno")
    cells[3] = F.concat(F.lit('[["https://g.example/'), (k % 10000).cast("string"), F.lit('"]]'))
    cells[12] = F.concat((k % 20).cast("string"), F.lit(" days ago"))
    cells[19], cells[28] = F.coalesce("description", F.lit("")), k.cast("string")
    return jobs(spark, folder).select("seq", J(F.array(*cells)).alias("value"))


@query("s15_google", needs="jobs", sql="""
with f as (select * from (select *, row_number() over (partition by id % 10000 order by id) as rn from jobs) where rn = 1)
select 'go-' || cast(id as varchar) as id, 'google' as site, 'https://g.example/' || cast(id % 10000 as varchar) as job_url, title, company, case when id % 2 = 0 then 'Reno, NV, USA' else 'Reno' end as location,
  date '2001-08-02' - cast(id % 20 as int) as date_posted, nullif(array_to_string(list_filter([case when regexp_matches(description, '(?i)full\\s?time') then 'fulltime' end,
  case when regexp_matches(description, '(?i)part\\s?time') then 'parttime' end, case when regexp_matches(description, '(?i)internship') then 'internship' end,
  case when regexp_matches(description, '(?i)contract') then 'contract' end], lambda t: t is not null), ', '), '') as job_type, null as interval, null as min_amount, null as max_amount, null as currency,
  regexp_matches(lower(coalesce(description, '')), 'remote|wfh') as is_remote from f
""")
def s15e(spark, folder):
    return sites.ingest_board(_google_raw(spark, folder), "google", NOW).select(*SITE_SHOWN)


@query("s6_merged_sites", needs="jobs", sql="""
with f as (select * from (select *, row_number() over (partition by id % 10000 order by id) as rn from jobs) where rn = 1)
select 'zip_recruiter' as site, count(*) as rows, count(salary_min) as with_pay, count(distinct id) as ids from jobs
union all select 'google', count(*), 0, count(distinct id) from f union all select 'glassdoor', count(*), count(salary_min), count(distinct id) from jobs
""")
def s6(spark, folder):
    merged = sites.merge_sites(
        sites.ingest_board(_zip_raw(spark, folder), "zip_recruiter", NOW),
        sites.ingest_board(_google_raw(spark, folder), "google", NOW),
        sites.ingest_board(_glassdoor_raw(spark, folder), "glassdoor", NOW).drop("skills"))
    return merged.groupBy("site").agg(F.count("*").alias("rows"), F.count("min_amount").alias("with_pay"),
                                      F.countDistinct("id").alias("ids"))


@query("p4_compiled_sites", needs="jobs", sql="""
with g as (select * from (select *, row_number() over (partition by id % 10000 order by id) as rn from jobs) where rn = 1),
d as (select id, 'go-' || cast(id as varchar) as key, id % 9 as r, case id % 9 when 0 then 1000 * (60 + id % 50) when 2 then 20 + id % 30 when 7 then 1000 * (80 + id % 9) end as a,
  case id % 9 when 0 then 1000 * (110 + id % 70) when 2 then 50 + id % 40 when 7 then 1000 * (100 + id % 30) end as b from g),
ok as (select *, coalesce(a < b, false) as good, case when r = 2 then 2080 else 1 end as f from d)
select 'zr-' || cast(id as varchar) as id, 'zip_recruiter' as site, case when salary_min <> 0 then 'direct_data' end as salary_source, 'yearly' as interval, salary_min::double as min_amount, salary_max::double as max_amount from jobs
union all select key, 'google', case when good then 'description' end, case when good then case when r = 2 then 'hourly' else 'yearly' end end, case when good then a * f end::double, case when good then b * f end::double from ok
""")
def p4(spark, folder):
    out = site_plan.compile_sites(
        sites.ingest_board(_zip_raw(spark, folder), "zip_recruiter", NOW),
        sites.ingest_board(_google_raw(spark, folder), "google", NOW), annual=True)
    return out.select("id", "site", "salary_source", "interval", "min_amount", "max_amount")


def _legacy_master(spark, folder):
    """Master rows as the text columns of the CSV list."""
    return master(spark, folder).select(
        F.when(F.col("id") % 3 == 0, F.lower("status")).when(F.col("id") % 3 == 1, F.concat(F.lit(" "), F.col("status"))).otherwise("odd").alias("status"),
        "title", "company", F.coalesce("location", F.lit("")).alias("location"), F.date_format("post_date", "yyyy-MM-dd").alias("date"),
        F.coalesce("description", F.lit("none")).alias("blurb"), F.lit("a,b").alias("tags"), F.col("url").alias("link"), F.col("key_id").alias("id"),
        F.lit("INDEED").alias("provider"), F.lit("python").alias("query"), F.lit("usa_english").alias("locale"), F.lit(" $5 ").alias("wage"), "remoteness")


MASTER_SQL = """select key_id, case id % 3 when 2 then 'UNKNOWN' else status end as status, title, post_date, post_date as scrape_date, 'USA_ENGLISH' as locale, '$5' as wage, remoteness,
  coalesce(description, 'none') as description, 2 as n_tags from master"""


@query("s7_master_list_scan", needs="master", sql=MASTER_SQL)
def s7(spark, folder):
    path = work_path(spark, "master-csv")
    _legacy_master(spark, folder).write.csv(path, **sinks.CSV)
    rows = files.read_master_csv(spark, path)
    return rows.select("key_id", "status", "title", "post_date", "scrape_date", "locale", "wage", "remoteness", "description",
                       F.size("tags").alias("n_tags"))


@query("s7_legacy_columns", needs="master", sql=MASTER_SQL.replace("'$5' as wage, remoteness", "'' as wage, 'UNKNOWN' as remoteness"))
def s7b(spark, folder):
    rows = files.decode_master(_legacy_master(spark, folder).drop("wage", "remoteness"))
    return rows.select("key_id", "status", "title", "post_date", "scrape_date", "locale", "wage", "remoteness", "description",
                       F.size("tags").alias("n_tags"))


@query("s8_recovered_master", needs="jobs", sql="""
select link as key_id, id, case when posted_date >= timestamp '1997-06-01' then 'second' else 'first' end as day from jobs
""")
def s8(spark, folder):
    path = work_path(spark, "snapshots")
    rows = jobs(spark, folder).select(F.col("link").alias("key_id"), "id", "posted_date")
    rows.filter("posted_date < timestamp '1999-01-01'").drop("posted_date").withColumn("day", F.lit("first")).write.parquet(f"{path}/2001-01-01")
    rows.filter("posted_date >= timestamp '1997-06-01'").drop("posted_date").withColumn("day", F.lit("second")).write.parquet(f"{path}/2001-01-02")
    return files.recover(spark, f"{path}/*")


def _job_table(spark, folder):
    """Every document as a page with a table of three roles; the second is continued."""
    row = ("<tr>\n<td><strong><a href=\"https://c.example\">%s</a></strong></td>\n<td>%s</td>\n<td>%s</td>\n"
           "<td><div align=\"center\">%s</div></td>\n<td>%s</td>\n</tr>")
    name = F.concat(F.lit("Firm "), "source")
    head = "<table><thead><tr><th>Company</th></tr></thead><tbody>"
    link = F.concat(F.lit('<a href="https://apply.example/'), F.col("doc_id").cast("string"), F.lit('"><img></a>'))
    return table(spark, folder, "documents").select(F.col("doc_id").alias("page_id"), F.concat(
        F.lit(head), F.format_string(row, F.concat(F.lit("🔥 "), name), F.lit("Engineer &amp; Lead"), F.lit("SF</br>NYC"), link, F.lit("1d")),
        F.format_string(row, F.lit("↳"), F.lit("Analyst 🛂"), F.col("lang"), F.lit("🔒"), F.lit("2d")),
        F.format_string(row, F.concat(F.lit("Other "), F.col("lang")), F.lit("Clerk 🇺🇸"), F.lit("Remote"), link, F.lit("3mo")),
        F.lit("</tbody></table>")).alias("html"))


@query("s9_html_job_lists", sql="""
select doc_id as page_id, 0 as pos, 'Firm ' || source as company, 'Engineer & Lead' as role, 'SF|NYC' as locations, 'https://apply.example/' || cast(doc_id as varchar) as apply_url, '1d' as age, false as closed, false as no_sponsorship, false as citizens_only from documents
union all select doc_id, 1, 'Firm ' || source, 'Analyst', lang, null, '2d', true, true, false from documents
union all select doc_id, 2, 'Other ' || lang, 'Clerk', 'Remote', 'https://apply.example/' || cast(doc_id as varchar), '3mo', false, false, true from documents
""")
def s9(spark, folder):
    rows = lists.ingest_job_lists(_job_table(spark, folder))
    return rows.withColumn("locations", F.array_join("locations", "|"))


@query("s10_markdown_lists", sql="""
select doc_id as page_id, 0 as pos, 'Firm ' || source as company, 'Engineer' as role, 'SF' as locations, null as apply_url, 'Jun 18' as date_posted, true as closed from documents
union all select doc_id, 1, 'Firm ' || source, 'Analyst', lang || '|NYC', 'https://a.example/' || cast(doc_id as varchar), 'Jun 13', false from documents
""")
def s10(spark, folder):
    text = F.concat(
        F.lit("# Roles\n| Company | Role | Location | Application/Link | Date Posted |\n| --- | --- | --- | :---: | :---: |\n| **[Firm "), "source",
        F.lit("](https://c.example)** | Engineer | SF | 🔒 | Jun 18 |\n| ↳ | Analyst | "), "lang",
        F.lit(" <br> NYC | [Apply](https://a.example/"), F.col("doc_id").cast("string"), F.lit(") | Jun 13 |\n"))
    pages = table(spark, folder, "documents").select(F.col("doc_id").alias("page_id"), text.alias("text"))
    return lists.ingest_markdown_lists(pages).withColumn("locations", F.array_join("locations", "|"))


@query("s12_posting_pages", sql=f"""
with p as (select page_id, url, html, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) as t, regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g') as body from pages)
select page_id, url, trim(regexp_replace({TAGLESS.format('t')}, '\\s+', ' ', 'g')) as title, len(regexp_extract_all(html, '(?i)<a\\s[^>]*?href="([^"]*)"', 1))::int as n_links,
  trim(regexp_replace({TAGLESS.format('body')}, '\\s+', ' ', 'g')) as text from p
""")
def s12(spark, folder):
    rows = lists.ingest_pages(table(spark, folder, "pages"))
    return rows.select("page_id", "url", "title", F.size("links").alias("n_links"), "text")


@query("s13_coerced_postings", needs="jobs", sql="""
select id, case when id % 3 = 0 then null else (id * 1.5)::double end as min_amount, case id % 4 when 0 then 'fulltime' when 1 then 'parttime' when 2 then 'contract' end as job_type, 'zip_recruiter' as site,
  case when id % 2 = 0 then 'remote' when contains(lower(coalesce(location, '')), 'hybrid') then 'hybrid' when contains(lower(coalesce(location, '')), 'remote') then 'remote' else 'onsite' end as location_type,
  nullif(trim(coalesce(location, '')), '') as location from jobs
""")
def s13(spark, folder):
    k = F.col("id")
    rows = jobs(spark, folder).select(
        "id", "location", F.when(k % 3 == 0, "n/a").otherwise((k * F.lit(1.5)).cast("double").cast("string")).alias("min_amount"), F.lit("").alias("max_amount"),
        F.lit("4.2").alias("company_rating"), F.lit(" Zip Recruiter ").alias("site"), (k % 2 == 0).cast("string").alias("is_remote"),
        F.when(k % 4 == 0, "Full-Time").when(k % 4 == 1, "part time").when(k % 4 == 2, "Contractor").otherwise("gig").alias("job_type"))
    return sites.coerce_postings(rows).select("id", "min_amount", "job_type", "site", "location_type", "location")


@query("s14_reread_export", needs="jobs sources", sql="""
select j.id, j.title, j.salary_min, j.first_seen_at, j.is_active, s.name as source_name from jobs j join sources s on j.source_id = s.id where j.is_active and s.compliance_status in ('approved', 'conditional')
""")
def s14(spark, folder):
    path = work_path(spark, "export")
    sinks.export_jsonl(export_rows(jobs(spark, folder), sources(spark, folder), form="json"), path)
    return files.read_export_jsonl(spark, path).select("id", "title", "salary_min", "first_seen_at", "is_active", "source_name")


@query("s16_taxonomy_board", needs="jobs", sql="""
select cast(id as varchar) as id, 'NEW' as status, title, company, date '2001-08-02' - cast(id % 30 as int) as date, 'Job types: Full-time, Permanent' || case when id % 3 = 0 then chr(10) || 'Remote: Hybrid work' when id % 3 = 1 then chr(10) || 'Remote: Remote' else '' end as tags,
  case when salary_min is null then '' else '$' || cast(salary_min as varchar) || ' - $' || cast(salary_max as varchar) || ' YEARLY' end as wage,
  case when id % 3 = 0 then 'TEMPORARILY_REMOTE' when id % 3 = 1 then 'FULLY_REMOTE' when id % 2 = 0 then 'FULLY_REMOTE' else 'UNKNOWN' end as remoteness from jobs
""")
def s16(spark, folder):
    k = F.col("id")
    labels = lambda *names: F.array(*[F.struct(F.lit(n).alias("label")) for n in names])
    group = lambda head, items: F.struct(F.lit(head).alias("label"), items.alias("attributes"))
    none = labels("x").cast("array<struct<label:string>>")
    remote = F.when(k % 3 == 0, labels("Hybrid work")).when(k % 3 == 1, labels("Remote")).otherwise(F.slice(none, 1, 0))
    raw = jobs(spark, folder).select(J(F.struct(
        F.col("title").alias("displayTitle"), F.col("description").alias("snippet"), "company", F.col("location").alias("formattedLocation"),
        F.array(group("job-types", labels("Full-time", "Permanent")), group("remote", remote)).alias("taxonomyAttributes"), (k % 2 == 0).alias("remoteLocation"),
        F.when(F.col("salary_min").isNotNull(), F.struct(F.col("salary_min").alias("min"), F.col("salary_max").alias("max"), F.lit("YEARLY").alias("type"))).alias("extractedSalary"),
        F.concat((k % 30).cast("string"), F.lit(" days ago")).alias("formattedRelativeTime"), k.cast("string").alias("jobkey"))).alias("value"))
    return sites.ingest_taxonomy_board(raw, NOW, "INDEED", "python", "USA_ENGLISH").select(
        "id", "status", "title", "company", "date", "tags", "wage", "remoteness")


@query("s17_company_site", needs="jobs", sql="""
select 'Acme' as company, title as job_title, 'https://acme.example' || case when id % 2 = 0 then '/p/' || cast(id as varchar) else '/en/jobs/' || cast(id as varchar) end as url,
  case when id % 3 = 0 then 'Remote - USA' when id % 3 = 1 then 'Town' when contains(lower(coalesce(location, '')), 'remote') then 'Remote - USA' else coalesce(location, 'USA') end as location,
  case when id % 5 = 0 then 'N/A' else strftime(posted_date, '%Y-%m-%d') end as posted_time from jobs
""")
def s17(spark, folder):
    k = F.col("id")
    spot = F.when(k % 3 == 0, F.array(F.lit('{"normalizedLocation": "Remote, US"}'))).when(k % 3 == 1, F.array(F.lit('{"normalizedLocation": "Town"}')))
    raw = jobs(spark, folder).select(J(F.struct(
        k.cast("string").alias("id"), "title", F.when(k % 2 == 0, F.concat(F.lit("/p/"), k.cast("string"))).otherwise("").alias("job_path"), "location", spot.alias("locations"),
        F.when(k % 5 == 0, "soon").otherwise(F.date_format("posted_date", "MMMM  d, yyyy")).alias("posted_date"))).alias("value"))
    return sites.ingest_company_site(raw, NOW, "Acme", "https://acme.example", "USA").drop("posted_datetime")


@query("s18_search_response", needs="jobs", sql="""
select cast(id as varchar) as job_id, title as job_title, 'https://www.linkedin.com/jobs/view/' || cast(id as varchar) || '/' as url from jobs where id % 4 <> 0
""")
def s18(spark, folder):
    k = F.col("id")
    item = lambda kind, again: F.struct(
        F.lit(kind).alias("$type"), again.alias("repostedJob"), F.concat(F.lit("urn:li:fsd_jobPosting:"), k.cast("string")).alias("entityUrn"), "title")
    raw = jobs(spark, folder).select(J(F.struct(F.array(
        item("com.linkedin.voyager.dash.jobs.JobPosting", k % 4 == 0), item("com.linkedin.other", F.lit(False))).alias("included"))).alias("value"))
    return sites.ingest_search_response(raw)


@query("s18_detail_lines", needs="jobs", sql="""
select id, case id % 3 when 2 then 'Reno' else 'Reno, NV' end as location, case id % 3 when 2 then 'Unknown' else cast(id % 9 as varchar) || ' days ago' end as repost_info,
  case id % 3 when 0 then cast(id % 50 as varchar) || ' applicants' else 'Unknown' end as apply_clicks from jobs
""")
def s18b(spark, folder):
    k = F.col("id")
    line = F.when(k % 3 == 2, "Reno").otherwise(F.concat(
        F.lit("Reno, NV · "), (k % 9).cast("string"), F.lit(" days ago"),
        F.when(k % 3 == 0, F.concat(F.lit(" · "), (k % 50).cast("string"), F.lit(" applicants"))).otherwise("")))
    return jobs(spark, folder).select("id", line.alias("line")).select("id", sites.detail_line("line").alias("d")).select("id", "d.*")


EXPORT_SQL = """select j.id, j.title, j.company, coalesce(j.location, '') as location, j.salary_min, strftime(j.first_seen_at, '%Y-%m-%dT%H:%M:%S') as first_seen_at, j.is_active, s.name as source_name
from jobs j join sources s on j.source_id = s.id where j.is_active and s.compliance_status in ('approved', 'conditional')"""


@query("k1_csv_export", needs="jobs sources", sql=EXPORT_SQL)
def k1(spark, folder):
    path = work_path(spark, "csv")
    rows = export_rows(jobs(spark, folder), sources(spark, folder))
    rows.write.csv(path, **sinks.CSV)
    back = spark.read.csv(path, schema=", ".join(f"{c} {t}" for c, t in rows.dtypes), multiLine=True, **sinks.CSV)
    return back.select("id", "title", "company", F.coalesce("location", F.lit("")).alias("location"), "salary_min", "first_seen_at", "is_active", "source_name")


@query("k2_json_export_metadata", needs="jobs sources", sql=f"""
select '2001-08-02T00:00:00' as exported_at, count(*) as job_count, '{{"active_only":"True","company":null}}' as filters from ({EXPORT_SQL})
""")
def k2(spark, folder):
    path = work_path(spark, "json")
    rows = export_rows(jobs(spark, folder), sources(spark, folder), form="json")
    sinks.export_json(rows, path, {"company": None, "active_only": True}, NOW)
    return spark.read.json(f"{path}/metadata").select("exported_at", "job_count", "filters")


@query("k3_json_lines_export", needs="jobs sources", sql=EXPORT_SQL)
def k3(spark, folder):
    path = work_path(spark, "jsonl")
    sinks.export_jsonl(export_rows(jobs(spark, folder), sources(spark, folder), form="json"), path)
    back = spark.read.schema("id long, title string, company string, location string, salary_min int, first_seen_at string, is_active boolean, source_name string").json(path)
    return back.withColumn("location", F.coalesce("location", F.lit("")))


@query("k4_master_list_rows", needs="master", sql="""
select status, title, company, coalesce(location, '') as location, strftime(post_date, '%Y-%m-%d') as date, description as blurb, 'a' || chr(10) || 'b' as tags, url as link, key_id as id, 'p' as provider, 'q' as query, 'USA_ENGLISH' as locale, '' as wage, remoteness
from master where length(description) >= 5 and title <> '' and company <> '' and url <> ''
""")
def k4(spark, folder):
    rows = master(spark, folder).withColumns({
        "tags": F.array(F.lit("a"), F.lit("b")), "provider": F.lit("p"), "query": F.lit("q"), "locale": F.lit("USA_ENGLISH"), "wage": F.lit("")})
    return sinks.master_rows(rows).withColumn("location", F.coalesce("location", F.lit("")))


@query("p5_export_rows", needs="jobs sources", sql=EXPORT_SQL.replace("where j.is_active", "where j.company ilike '%corp%' and j.is_active"))
def p5(spark, folder):
    rows = export_rows(jobs(spark, folder), sources(spark, folder), company="corp")
    return rows.select("id", "title", "company", F.coalesce("location", F.lit("")).alias("location"), "salary_min", "first_seen_at", "is_active", "source_name")
