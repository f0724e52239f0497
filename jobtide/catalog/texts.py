"""Normalisation, hashing, salary, date and classification rules over whole tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import classify, dates, fixed, normalize, salary, text
from ..session import shared
from . import base
from .base import companies, query, table, vacancies
from .base import heavy_docs as docs
from .base import heavy_jobs as jobs

NOW = datetime(2001, 8, 2, 12, 30)
NOW_SQL = "timestamp '2001-08-02 12:30:00'"


def sql_map(values: dict, key: str) -> str:
    """CASE of a fixed table."""
    arms = " ".join(
        f"when '{str(k).replace(chr(39), chr(39) * 2)}' then "
        + (f"'{v.replace(chr(39), chr(39) * 2)}'" if isinstance(v, str) else str(v)) for k, v in values.items())
    return f"case {key} {arms} end"


def sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


# Hashes, URLs and plain text.

HASH_FORM = "trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce({0}, '')), '\\s+', ' ', 'g'), '[,.\\-_/\\\\|]', ' ', 'g'), '\\s+', ' ', 'g'))"
TAGLESS = ("replace(replace(replace(replace(replace(regexp_replace(coalesce({0}, ''), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), "
           "'&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"')")


@query("d1_content_hash", needs="jobs", sql=f"""
select id, content_hash as strict_hash, sha256({HASH_FORM.format('title')} || '|' || {HASH_FORM.format('company')} || '|' || {HASH_FORM.format('location')}) as loose_hash from jobs
""")
def d1(spark, folder):
    return jobs(spark, folder).select(
        "id", text.content_hash("title", "company", "location").alias("strict_hash"),
        text.content_hash("title", "company", "location", "normalised").alias("loose_hash"))


@query("d2_description_hash", needs="jobs", sql=f"""
select id, sha256({HASH_FORM.format(TAGLESS.format('description'))}) as description_hash from jobs
""")
def d2(spark, folder):
    return jobs(spark, folder).select("id", text.description_hash("description").alias("description_hash"))


URL_BASE = "regexp_replace(regexp_replace(split_part(split_part(lower(url), '#', 1), '?', 1), '://www\\.', '://'), '/+$', '')"
URL_QUERY = ("array_to_string(list_filter(string_split(split_part(split_part(lower(url), '#', 1), '?', 2), '&'), "
             "lambda p: not regexp_matches(p, '^(utm_source|utm_medium|utm_campaign|utm_term|utm_content|ref|source|fbclid|gclid)=')), '&')")


@query("d3_normal_url_of_pages", sql=f"""
select page_id, {URL_BASE} || case when {URL_QUERY} = '' then '' else '?' || {URL_QUERY} end as normal_url from pages
""")
def d3(spark, folder):
    return shared(table(spark, folder, "pages")).select("page_id", text.normalize_url("url").alias("normal_url"))


@query("d3_normal_url_of_jobs", needs="jobs", sql="""
select id, 'https://board.example/jobs/' || cast(id % 9000 as varchar) || '?team=' || cast(id % 3 as varchar) as normal_url from jobs
""")
def d3b(spark, folder):
    return jobs(spark, folder).select("id", text.normalize_url("url").alias("normal_url"))


@query("d11_change_hash", needs="jobs", sql="""
select id, md5(title || coalesce(description, '') || coalesce(location, '') || case when company_id = 0 then 'unknown' else cast(company_id as varchar) end
  || case when salary_min is null then '' else cast(salary_min as varchar) || '-' || cast(salary_max as varchar) end
  || strftime(posted_date, '%Y-%m-%dT%H:%M:%S')) as change_hash,
  md5(title || '|' || coalesce(description, '') || '|' || link) as posting_hash from jobs
""")
def d11(spark, folder):
    return jobs(spark, folder).select(
        "id", text.change_hash("title", "description", "location", "company_id", "salary_min", "salary_max",
                               "posted_date").alias("change_hash"),
        text.posting_hash("title", "description", "link").alias("posting_hash"))


SUFFIX_SQL = "[" + sql_list(fixed.ALIAS_ENDINGS) + "]"


@query("d16_alias_match", needs="companies", sql=f"""
with flat as (select id, regexp_replace(lower(alias), '[-.]', '', 'g') as a, regexp_replace(lower(second_alias), '[-.]', '', 'g') as b from companies)
select id, a = b or len(list_filter({SUFFIX_SQL}, lambda s:
  (case when suffix(a, s) then a[1:len(a) - len(s)] else a end) = (case when suffix(b, s) then b[1:len(b) - len(s)] else b end))) > 0 as same from flat
""")
def d16(spark, folder):
    return companies(spark, folder).select("id", text.alias_equal("alias", "second_alias").alias("same"))


@query("n12_plain_text", sql=f"""
select page_id, trim(regexp_replace({TAGLESS.format('html')}, '\\s+', ' ', 'g')) as plain from pages
""")
def n12(spark, folder):
    return shared(table(spark, folder, "pages")).select("page_id", text.plain_text("html").alias("plain"))


EMAIL_SQL = "[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}"


@query("n13_emails", sql=f"""
with found as (select doc_id, regexp_extract_all(text, '{EMAIL_SQL}') as e from documents)
select doc_id, cast(len(e) as int) as n, nullif(array_to_string(e, ', '), '') as emails from found
""")
def n13(spark, folder):
    return shared(table(spark, folder, "documents")).select(
        "doc_id", F.size(text.emails("text")).alias("n"), text.joined(text.emails("text")).alias("emails"))


@query("n24_truncated_text", sql="""
select doc_id, case when length(text) <= 80 then text else substr(text, 1, 77) || '...' end as short from documents
""")
def n24(spark, folder):
    return shared(table(spark, folder, "documents")).select("doc_id", text.truncate("text", 80).alias("short"))


@query("n25_url_parts", sql="""
select page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1) as host,
  split_part(split_part(url, '#', 1), '?', 1) || coalesce('#' || nullif(split_part(url, '#', 2), ''), '') as bare,
  array_to_string(list_reverse(list_reverse(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '.'))[1:2]), '.') as domain
from pages
""")
def n25(spark, folder):
    return shared(table(spark, folder, "pages")).select(
        "page_id", text.hostname("url").alias("host"), text.url_without_query("url").alias("bare"),
        text.second_level_domain("url").alias("domain"))


@query("n28_vacancy_description", needs="vacancies", sql="""
select id, case when short_description = '' then switching when switching = '' then short_description
  else short_description || '. ' || switching end as description from vacancies
""")
def n28(spark, folder):
    return vacancies(spark, folder).select(
        "id", text.merge_descriptions("short_description", "switching").alias("description"))


@query("n29_printable_text", sql="""
select doc_id, regexp_replace(text, '[^ -~\\t\\n\\r\\x0B\\x0C]', '', 'g') as printable from documents
""")
def n29(spark, folder):
    return shared(table(spark, folder, "documents")).select("doc_id", text.printable("text").alias("printable"))


@query("n35_provider_key", needs="docs", sql="select id, lang || '_' || key_id as provider_key from docs")
def n35(spark, folder):
    return docs(spark, folder).select("id", text.provider_key("lang", "key_id").alias("provider_key"))


# Titles, places, companies, codes.

WORDS_SQL = {k: v for k, v in fixed.TITLE_WORDS.items() if "." not in k}


@query("n1_title", needs="jobs", sql=f"""
with parts as (select id, string_split(trim(regexp_replace(title, '\\s+', ' ', 'g')), ' ') as ws from jobs),
wide as (select id, string_split(array_to_string(list_transform(ws, lambda w:
  coalesce({sql_map(WORDS_SQL, "regexp_replace(lower(w), '[.,]+$', '')")}, w)), ' '), ' ') as ws from parts)
select id, array_to_string(list_transform(ws, lambda w: case
  when upper(w) in ({sql_list(a for a in fixed.ACRONYMS if a == a.upper())}) or regexp_matches(upper(w), '^[IVX]+$') then upper(w)
  else upper(w[1]) || lower(w[2:]) end), ' ') as title from wide
""")
def n1(spark, folder):
    return jobs(spark, folder).select("id", normalize.normalize_title("title").alias("title"))


CODE_SQL = sql_map({v: k.title() for k, v in fixed.US_STATES.items()}, "upper(p)")
LOC_CASES = {
    # Location text of the job data -> its parts, worked out by hand.
    "SF, CA": ("San Francisco", "California", "CA", "United States", "US", False, "San Francisco, CA"),
    "Remote - US": (None, None, None, "United States", "US", True, "Remote"),
    "London, UK": ("London", None, None, "United Kingdom", "UK", False, "London, UK"),
    "New York, NY": ("New York", "New York", "NY", "United States", "US", False, "New York, NY"),
    "Austin, TX, United States": ("Austin", "Texas", "TX", "United States", "US", False, "Austin, TX"),
    "Hybrid / Seattle": ("Hybrid", None, None, None, None, False, "Hybrid"),
    "berlin": ("Berlin", None, None, None, None, False, "Berlin"),
    "Toronto, Canada": ("Toronto", None, None, "Canada", "CA", False, "Toronto, CA"),
    "remote": (None, None, None, None, None, True, "Remote"),
    "LA/California": ("Los Angeles", "California", "CA", "United States", "US", False, "Los Angeles, CA"),
    "Vancouver, Washington, Canada": ("Vancouver", "Washington", "WA", "United States", "US", False, "Vancouver, WA"),
    "Canada - Ottawa": ("Ottawa", None, None, "Canada", "CA", False, "Ottawa, CA"),
    "Work From Home, st. paul, minnesota": ("St. Paul", "Minnesota", "MN", "United States", "US", True, "Remote (St. Paul, MN)"),
    "": (None, None, None, None, None, False, ""),
}


def _cell(v) -> str:
    return "null" if v is None else str(v).lower() if isinstance(v, bool) else "'" + v.replace("'", "''") + "'"


LOC_VALUES = ", ".join("(" + ", ".join(_cell(x) for x in (k, *v)) + ")" for k, v in LOC_CASES.items())
# "New York, NY": "New York" is a state name and "NY" a city alias.


@query("n2_location_parts", needs="jobs", sql=f"""
with known(raw, city, state, state_code, country, country_code, is_remote, label) as (values {LOC_VALUES})
select id, city, state, state_code, country, country_code, is_remote, label from jobs join known on coalesce(location, '') = raw
""")
def n2(spark, folder):
    rows = jobs(spark, folder).select("id", normalize.parse_location("location").alias("place"))
    return rows.select("id", *[f"place.{f}" for f in ("city", "state", "state_code", "country", "country_code", "is_remote")],
                       normalize.location_label("place").alias("label"))


@query("n3_location_label", needs="jobs", sql=f"""
with known(raw, city, state, state_code, country, country_code, is_remote, label) as (values {LOC_VALUES})
select label, count(*) as postings from jobs join known on coalesce(location, '') = raw group by label
""")
def n3(spark, folder):
    labels = jobs(spark, folder).select(normalize.location_label(normalize.parse_location("location")).alias("label"))
    return labels.groupBy("label").agg(F.count("*").alias("postings"))


@query("n5_company_name", needs="jobs", sql="""
select id, regexp_replace(company, '(, Inc\\.| LLC| Ltd| Corp)$', '') as company from jobs
""")
def n5(spark, folder):
    return jobs(spark, folder).select("id", normalize.normalize_company("company").alias("company"))


TYPE_WORDS = base.pick("o_orderkey", "Full-time", "Vollzeit", "tiempo completo", "part time", "Praktikum", "OJT (On the job training)",
                       "全职", "contractor", "per diem", "gardening", "Plný úvazek")


@query("n15_job_type_codes", sql=f"""
with w as (select o_orderkey as id, {TYPE_WORDS} as word from orders)
select id, case word when 'Full-time' then 'fulltime' when 'Vollzeit' then 'fulltime' when 'tiempo completo' then 'fulltime'
  when 'part time' then 'parttime' when 'Praktikum' then 'internship' when 'OJT (On the job training)' then 'internship'
  when '全职' then 'fulltime' when 'contractor' then 'contract' when 'per diem' then 'perdiem' when 'Plný úvazek' then 'fulltime' end as code,
  case word when 'Full-time' then 'fulltime' when 'part time' then 'parttime' when 'contractor' then 'contract' end as tracker_code from w
""")
def n15(spark, folder):
    words = shared(table(spark, folder, "orders")).selectExpr("o_orderkey as id", f"{TYPE_WORDS} as word")
    return words.select("id", normalize.job_type_code("word").alias("code"),
                        normalize.tracker_job_type("word").alias("tracker_code"))


COUNTRY_WORDS = base.pick("c_custkey", "US", " united kingdom ", "Czechia", "Turkey", "hong kong", "Atlantis", "Germany", "usa", "UNITED ARAB EMIRATES")


@query("n16_country_names", sql=f"""
with w as (select c_custkey as id, {COUNTRY_WORDS} as word from customer)
select id, case word when 'US' then 'usa' when 'usa' then 'usa' when ' united kingdom ' then 'uk' when 'Czechia' then 'czech republic'
  when 'Turkey' then 'türkiye' when 'hong kong' then 'hong kong' when 'Germany' then 'germany' when 'UNITED ARAB EMIRATES' then 'united arab emirates' end as country,
  'Town, ' || case word when 'US' then 'USA' when 'usa' then 'USA' when ' united kingdom ' then 'UK' when 'Czechia' then 'Czech Republic'
  when 'Turkey' then 'Türkiye' when 'hong kong' then 'Hong Kong' when 'Germany' then 'Germany' when 'UNITED ARAB EMIRATES' then 'United Arab Emirates'
  else word end as shown from w
""")
def n16(spark, folder):
    words = table(spark, folder, "customer").selectExpr("c_custkey as id", f"{COUNTRY_WORDS} as word")
    return words.select("id", normalize.country_name("word").alias("country"),
                        normalize.site_location(F.lit("Town"), F.lit(""), "word").alias("shown"))


@query("n17_city_and_state", needs="jobs", sql="""
select id, case when location is null or trim(location) = '' then null else split_part(location, ', ', 1) end as city,
  case when location is null or trim(location) = '' then null else substr(location, length(split_part(location, ', ', 1)) + 3) end as state,
  trim(split_part(location, ',', 1)) as loose_city,
  case when location like '%,%' then trim(split_part(location, ',', 2)) end as loose_state from jobs
""")
def n17(spark, folder):
    rows = jobs(spark, folder).select("id", normalize.city_state("location").alias("a"),
                                      normalize.city_state_loose("location").alias("b"))
    return rows.select("id", "a.city", "a.state", F.col("b.city").alias("loose_city"), F.col("b.state").alias("loose_state"))


@query("n26_remote_flag", needs="jobs", sql="""
select id, regexp_matches(lower(title || ' ' || coalesce(description, '') || ' ' || coalesce(location, '')), 'remote|work from home|wfh') as is_remote from jobs
""")
def n26(spark, folder):
    return jobs(spark, folder).select("id", normalize.remote_flag("title", "description", "location").alias("is_remote"))


@query("n27_location_type", needs="jobs", sql="""
select id, case when id % 3 = 0 then 'remote' when contains(lower(coalesce(location, '')), 'hybrid') then 'hybrid'
  when contains(lower(coalesce(location, '')), 'remote') then 'remote' else 'onsite' end as location_type from jobs
""")
def n27(spark, folder):
    return jobs(spark, folder).select("id", normalize.location_type(F.col("id") % 3 == 0, "location").alias("location_type"))


@query("n32_work_from_home_type", needs="jobs", sql="""
select id, case when contains(lower(coalesce(location, '') || '|' || title || '|' || coalesce(description, '')), 'hybrid') then 'Hybrid'
  when contains(lower(coalesce(location, '') || '|' || title || '|' || coalesce(description, '')), 'remote') then 'Remote' else 'Work from office' end as kind from jobs
""")
def n32(spark, folder):
    return jobs(spark, folder).select("id", normalize.work_from_home_type("location", "title", "description").alias("kind"))


@query("n34_industry_label", sql="""
select o_orderkey as id, array_to_string(list_transform(string_split('software ' || lower(split_part(o_orderpriority, '-', 2)), ' '),
  lambda w: upper(w[1]) || w[2:]), ' ') as label from orders
""")
def n34(spark, folder):
    codes = shared(table(spark, folder, "orders")).selectExpr(
        "o_orderkey as id", "'Iv1SOFTWARE_' || replace(split_part(o_orderpriority, '-', 2), ' ', '_') as code")
    return codes.select("id", normalize.industry_label("code").alias("label"))


@query("n14_job_type_tags", needs="jobs", sql="""
select id, nullif(array_to_string(list_filter([case when regexp_matches(description, '(?i)full\\s?time') then 'fulltime' end,
  case when regexp_matches(description, '(?i)part\\s?time') then 'parttime' end, case when regexp_matches(description, '(?i)internship') then 'internship' end,
  case when regexp_matches(description, '(?i)contract') then 'contract' end], lambda t: t is not null), ', '), '') as tags from jobs
""")
def n14(spark, folder):
    return jobs(spark, folder).select("id", text.joined(normalize.job_type_tags("description")).alias("tags"))


NUMBER_TEXT = base.pick("o_orderkey", "$1,234.56", "1.234,56 EUR", "12,000", "USD 99.9", "1500", "12.5", "-7,25", "1,234,567.89", "n/a")


@query("n11_number_text", sql=f"""
with w as (select o_orderkey as id, {NUMBER_TEXT} as word from orders)
select id, case word when '$1,234.56' then 1234.56 when '1.234,56 EUR' then 1234.56 when '12,000' then 12000.0 when 'USD 99.9' then 99.9
  when '1500' then 1500.0 when '12.5' then 12.5 when '-7,25' then -7.25 when '1,234,567.89' then 1234567.89 end::double as number from w
""")
def n11(spark, folder):
    words = shared(table(spark, folder, "orders")).selectExpr("o_orderkey as id", f"{NUMBER_TEXT} as word")
    return words.select("id", normalize.number_text("word").alias("number"))


# Salaries.

RATE_SQL = sql_map(fixed.CURRENCY_RATES, "upper(coalesce(salary_currency, 'USD'))")
PERIOD_SQL = ("case when regexp_matches(lower(coalesce(pay_period, '')), 'hour|hr|/h') then 2080 when regexp_matches(lower(coalesce(pay_period, '')), 'day|/d') then 260 "
              "when regexp_matches(lower(coalesce(pay_period, '')), 'week|/w|wk') then 52 when regexp_matches(lower(coalesce(pay_period, '')), 'month|/m|mo') then 12 else 1 end")


@query("n4_annual_salary", needs="jobs", sql=f"""
with v as (select id, cast(round_even(salary_min * coalesce({RATE_SQL}, 1.0)::double * {PERIOD_SQL} / 1000, 0) * 1000 as int) as a,
  cast(round_even(salary_max * coalesce({RATE_SQL}, 1.0)::double * {PERIOD_SQL} / 1000, 0) * 1000 as int) as b,
  coalesce(lower(pay_period), '') not in ('yearly') as is_estimated from jobs)
select id, a as min_yearly, b as max_yearly, is_estimated from v
""")
def n4(spark, folder):
    rows = jobs(spark, folder).select("id", salary.annualize_salary(
        "salary_min", "salary_max", "pay_period", "salary_currency").alias("s"))
    return rows.select("id", "s.min_yearly", "s.max_yearly", "s.is_estimated")


@query("n6_salary_in_text", needs="jobs", sql="""
with m as (select id, description as d from jobs),
v as (select id,
  case when id % 9 = 0 then 1000 * (60 + id % 50) when id % 9 = 2 then 2080 * (20 + id % 30) when id % 9 = 6 then 100000
    when id % 9 = 7 then 1000 * (80 + id % 9) end as a,
  case when id % 9 = 0 then 1000 * (110 + id % 70) when id % 9 = 2 then 2080 * (50 + id % 40) when id % 9 = 6 then 150000
    when id % 9 = 7 then 1000 * (100 + id % 30) end as b from m)
select id, cast(round_even(least(a, b) / 1000.0, 0) * 1000 as int) as min_yearly, cast(round_even(greatest(a, b) / 1000.0, 0) * 1000 as int) as max_yearly,
  case when id % 9 = 7 then 0 else cast(round_even(least(a, b) / 1000.0, 0) * 1000 as int) end as min_without_k from v
""")
def n6(spark, folder):
    rows = jobs(spark, folder).select("id", salary.extract_salary("description").alias("s"),
                                      salary.extract_salary("description", honor_k=False).alias("p"))
    return rows.select("id", "s.min_yearly", "s.max_yearly", F.col("p.min_yearly").alias("min_without_k"))


@query("n7_salary_interval", needs="docs", sql="""
with m as (select id, regexp_extract(description, '\\$([0-9]+(?:,[0-9]+)?(?:\\.[0-9]+)?)([kK]?)\\s*[-—–]\\s*(?:\\$)?([0-9]+(?:,[0-9]+)?(?:\\.[0-9]+)?)([kK]?)', ['a', 'ka', 'b', 'kb']) as g from docs),
n as (select id, try_cast(floor(try_cast(replace(g.a, ',', '') as double)) as bigint) * (case when g.ka <> '' or g.kb <> '' then 1000 else 1 end) as a,
  try_cast(floor(try_cast(replace(g.b, ',', '') as double)) as bigint) * (case when g.ka <> '' or g.kb <> '' then 1000 else 1 end) as b from m),
i as (select *, case when a < 350 then 'hourly' when a < 30000 then 'monthly' else 'yearly' end as interval, case when a < 350 then 2080 when a < 30000 then 12 else 1 end as f,
  case when a < 350 then b < 350 when a < 30000 then b < 30000 else true end as fits from n),
ok as (select *, coalesce(fits and a * f between 1000 and 700000 and b * f between 1000 and 700000 and a * f < b * f, false) as good from i)
select id, case when good then interval end as interval, case when good then a end as min_amount, case when good then b * f end as max_yearly from ok
""")
def n7(spark, folder):
    rows = docs(spark, folder).select("id", salary.extract_salary_interval("description").alias("s"),
                                      salary.extract_salary_interval("description", annual=True).alias("y"))
    return rows.select("id", "s.interval", "s.min_amount", F.col("y.max_amount").alias("max_yearly"))


INTERVALS = base.pick("o_orderkey", "hourly", "daily", "weekly", "monthly", "yearly", None)


@query("n8_yearly_amount", sql=f"""
select o_orderkey as id, round(o_totalprice * case {INTERVALS} when 'hourly' then 2080 when 'daily' then 260 when 'weekly' then 52 when 'monthly' then 12 else 1 end, 2) as yearly from orders
""")
def n8(spark, folder):
    rows = shared(table(spark, folder, "orders")).selectExpr("o_orderkey as id", "o_totalprice as amount", f"{INTERVALS} as interval")
    return rows.select("id", F.round(salary.yearly_amount("amount", "interval"), 2).alias("yearly"))


@query("n9_salary_source", needs="jobs", sql="""
select id, case when salary_min is not null and salary_min <> 0 then 'direct_data'
  when id % 9 = 0 and 60 + id % 50 < 110 + id % 70 or id % 9 = 2 and 20 + id % 30 < 50 + id % 40 or id % 9 = 7 and 80 + id % 9 < 100 + id % 30 then 'description' end as salary_source from jobs
""")
def n9(spark, folder):
    described = salary.extract_salary_interval("description")["min_amount"]
    return jobs(spark, folder).select("id", salary.salary_source("salary_min", described).alias("salary_source"))


SALARY_TEXT = """case {K} % 12
  when 0 then 'up to $' || cast(90 + {K} % 60 as string) || 'k'
  when 1 then 'from £' || cast(40 + {K} % 60 as string) || ',000'
  when 2 then cast(100 + {K} % 20 as string) || '-' || cast(130 + {K} % 20 as string) || 'k'
  when 3 then '$' || cast(20 + {K} % 50 as string) || ' per hour'
  when 4 then '€' || cast(3000 + {K} % 900 as string) || ' per month'
  when 5 then '110k to 150k'
  when 6 then 'Salary range: $' || cast(100 + {K} % 50 as string) || ',000 - $' || cast(160 + {K} % 50 as string) || ',000 per annum'
  when 7 then 'Competitive package'
  when 8 then '125.5k'
  when 9 then '  '
  when 10 then '100k-' || cast(120 + {K} % 10 as string)
  else cast(55000 + {K} % 5000 as string) || ' plus benefits' end""".replace("{K}", "o_orderkey")


@query("n10_salary_text", sql="""
select id, case r when 1 then 1000 * (40 + id % 60) when 2 then 1000 * (100 + id % 20) when 3 then 2080 * (20 + id % 50) when 4 then 12 * (3000 + id % 900)
  when 5 then 110000 when 6 then 1000 * (100 + id % 50) when 8 then 125500 when 10 then 100000 when 11 then 55000 + id % 5000 end as min_salary,
  case r when 0 then 1000 * (90 + id % 60) when 2 then 1000 * (130 + id % 20) when 3 then 2080 * (20 + id % 50) when 4 then 12 * (3000 + id % 900)
  when 5 then 150000 when 6 then 1000 * (160 + id % 50) when 8 then 125500 when 10 then 1000 * (120 + id % 10) when 11 then 55000 + id % 5000 end as max_salary
from (select o_orderkey as id, o_orderkey % 12 as r from orders)
""")
def n10(spark, folder):
    rows = shared(table(spark, folder, "orders")).selectExpr("o_orderkey as id", f"{SALARY_TEXT} as pay")
    parsed = rows.select("id", salary.parse_salary_text("pay").alias("s"))
    return parsed.select("id", "s.min_salary", "s.max_salary")


@query("n18_nested_pay", needs="jobs", sql="""
select id, case id % 3 when 0 then 'hourly' when 1 then 'yearly' end as interval, case when id % 3 <> 2 then cast(salary_min as bigint) end as min_amount,
  case when id % 3 <> 2 then cast(salary_max as bigint) end as max_amount, case id % 3 when 0 then 'USD' when 1 then 'EUR' end as currency,
  cast(floor(salary_min / 7.0) as bigint) as p10, cast(floor(salary_max / 7.0) as bigint) as p90 from jobs
""")
def n18(spark, folder):
    unit = F.when(F.col("id") % 3 == 0, "Hour").otherwise("YEAR")
    pay = F.struct(unit.alias("unitOfWork"), F.struct(F.col("salary_min").alias("min"), F.col("salary_max").alias("max")).alias("range"))
    landed = F.to_json(F.struct(
        F.when(F.col("id") % 3 == 0, pay).alias("baseSalary"), F.lit("USD").alias("currencyCode"),
        F.when(F.col("id") % 3 == 1, F.struct(F.lit("EUR").alias("currencyCode"), pay.alias("baseSalary"))).alias("estimated")))
    rows = jobs(spark, folder).select("id", "salary_min", "salary_max",
                                      F.from_json(landed, f"struct<{salary.PAY_SCHEMA}>").alias("pay"))
    told = rows.select("id", salary.nested_compensation("pay").alias("s"), salary.percentile_compensation(
        F.lit("ANNUAL"), F.col("salary_min") / 7.0, F.col("salary_max") / 7.0, F.lit(None).cast("string")).alias("p"))
    return told.select("id", "s.interval", "s.min_amount", "s.max_amount", "s.currency",
                       F.col("p.min_amount").alias("p10"), F.col("p.max_amount").alias("p90"))


@query("n23_salary_labels", needs="jobs", sql="""
select id, case when salary_min is null then 'Not specified' when salary_min = salary_max then '$' || format('{:,}', salary_min)
  else '$' || format('{:,}', salary_min) || ' - $' || format('{:,}', salary_max) end as label,
  case when salary_max is null then '$0' when salary_max < 1000 then '$' || cast(salary_max as varchar)
    when salary_max < 1000000 then '$' || cast(salary_max // 1000 as varchar) || 'k' else '$' || printf('%.1f', salary_max / 1000000.0) || 'M' end as compact,
  case when id % 2 = 0 then case when salary_min is null then 'Not specified' else 'Up to $' || format('{:,}', salary_min) || '/year' end
    else case when salary_min is null then 'Not specified' else '$' || format('{:,}', salary_min) || '+/year' end end as one_sided from jobs
""")
def n23(spark, folder):
    low = F.when(F.col("id") % 2 == 1, F.col("salary_min"))
    high = F.when(F.col("id") % 2 == 0, F.col("salary_min"))
    return jobs(spark, folder).select(
        "id", salary.salary_range_label("salary_min", "salary_max").alias("label"),
        salary.salary_compact("salary_max").alias("compact"),
        salary.salary_range_label(low, high, per_year=True).alias("one_sided"))


LAKH_TEXT = ("case o_orderkey % 4 when 0 then cast(o_orderkey % 20 as string) || '-' || cast(o_orderkey % 20 + 5 as string) || ' Lacs P.A.' "
             "when 1 then '1.5 - 2.5 Cr' when 2 then 'Not disclosed' else cast(o_orderkey % 9 as string) || '-' || cast(o_orderkey % 9 + 2 as string) || ' lakh' end")


@query("n31_lakh_and_crore", sql="""
select o_orderkey as id, case o_orderkey % 4 when 0 then 100000 * (o_orderkey % 20) when 1 then 15000000 when 3 then 100000 * (o_orderkey % 9) end as min_amount,
  case o_orderkey % 4 when 0 then 100000 * (o_orderkey % 20 + 5) when 1 then 25000000 when 3 then 100000 * (o_orderkey % 9 + 2) end as max_amount from orders
""")
def n31(spark, folder):
    rows = shared(table(spark, folder, "orders")).selectExpr("o_orderkey as id", f"{LAKH_TEXT} as pay")
    return rows.select("id", salary.indian_salary("pay").alias("s")).select("id", "s.min_amount", "s.max_amount")


@query("n36_range_cell", sql="""
select o_orderkey as id, case when o_orderkey % 2 = 0 then 'USD' else '£' end as currency,
  cast(floor(round(o_totalprice, 2)) as bigint) as min_amount, cast(floor(round(o_totalprice * 2, 2)) as bigint) as max_amount from orders
""")
def n36(spark, folder):
    sign = "case when o_orderkey % 2 = 0 then '$' else '£' end"
    rows = shared(table(spark, folder, "orders")).selectExpr(
        "o_orderkey as id", f"{sign} || format_number(o_totalprice, 2) || ' - ' || {sign} || format_number(o_totalprice * 2, 2) as cell")
    return rows.select("id", salary.range_cell("cell").alias("s")).select("id", "s.currency", "s.min_amount", "s.max_amount")


# Dates.

AGE_TEXT = ("case o_orderkey % 9 when 0 then cast(o_orderkey % 40 as string) || ' hours ago' when 1 then cast(o_orderkey % 30 as string) || ' days ago' "
            "when 2 then '30+d' when 3 then cast(o_orderkey % 11 as string) || ' month ago' when 4 then 'Yesterday' when 5 then 'Just posted' "
            "when 6 then '2 year ago' when 7 then '7 heures' else null end")


@query("n19_relative_dates", sql=f"""
select o_orderkey as id, cast(case o_orderkey % 9 when 0 then {NOW_SQL} - to_hours(o_orderkey % 40) when 1 then date '2001-08-02' - cast(o_orderkey % 30 as int)
  when 2 then date '2001-07-03' when 3 then {NOW_SQL} - to_months(cast(o_orderkey % 11 as int)) when 4 then date '2001-08-01' when 5 then date '2001-08-02'
  when 6 then date '1999-08-02' when 7 then {NOW_SQL} - interval 7 hours end as date) as posted from orders
""")
def n19(spark, folder):
    rows = shared(table(spark, folder, "orders")).selectExpr("o_orderkey as id", f"{AGE_TEXT} as age")
    return rows.select("id", dates.relative_date("age", F.lit(NOW)).alias("posted"))


@query("n20_date_texts", sql="""
select o_orderkey as id, case when o_orderkey % 7 = 6 then null else cast(o_orderdate as timestamp) end as posted from orders
""")
def n20(spark, folder):
    rows = shared(table(spark, folder, "orders")).withColumn("d", F.col("o_orderdate").cast("timestamp"))
    forms = ["yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "MMMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "yyyy-MM-dd'T'HH:mm:ss'Z'"]
    written = F.lit("soon")
    for i, form in enumerate(forms):
        written = F.when(F.col("o_orderkey") % 7 == i, F.date_format("d", form)).otherwise(written)
    return rows.select(F.col("o_orderkey").alias("id"), dates.parse_date(written).alias("posted"))


@query("n21_local_time", needs="views", sql="""
select event_id, strftime(ts - interval 5 hours, '%Y-%m-%d %H:%M:%S') as eastern from views
""")
def n21(spark, folder):
    return base.views(spark, folder).select("event_id", dates.local_time(F.unix_timestamp("ts")).alias("eastern"))


@query("n22_days_since", needs="jobs", sql=f"""
select id, cast(floor((epoch({NOW_SQL}) - epoch(last_seen_at)) / 86400) as int) as days, floor((epoch({NOW_SQL}) - epoch(last_seen_at)) / 86400) <= 7 as recent from jobs
""")
def n22(spark, folder):
    return jobs(spark, folder).select("id", dates.days_since("last_seen_at", F.lit(NOW)).alias("days"),
                                      dates.recently_posted("last_seen_at", F.lit(NOW)).alias("recent"))


@query("n24_relative_labels", needs="jobs", sql=f"""
with s as (select id, cast(floor(epoch({NOW_SQL}) - epoch(posted_date)) as bigint) as s from jobs), d as (select id, s, s // 86400 as d from s)
select id, case when s < 86400 then case when s // 3600 = 1 then 'an hour ago' else cast(s // 3600 as varchar) || ' hours ago' end
  when d < 31 then case when d = 1 then 'a day ago' else cast(d as varchar) || ' days ago' end
  when d < 365 then case when greatest(floor(d / 30.5), 1) = 1 then 'a month ago' else cast(cast(floor(d / 30.5) as bigint) as varchar) || ' months ago' end
  else case when d // 365 = 1 then 'a year ago' else cast(d // 365 as varchar) || ' years ago' end end as label from d
""")
def n24b(spark, folder):
    return jobs(spark, folder).select("id", dates.relative_label("posted_date", F.lit(NOW)).alias("label"))


@query("n30_run_pace", sql="""
with p as (select l_orderkey, cast(l_linenumber as int) as line, l_partkey, l_quantity as q,
  cast(floor((6 - l_linenumber) * (l_quantity / l_linenumber)) as bigint) as t from lineitem)
select l_orderkey, line, case when q < 10 then 0.0 else round_even(l_partkey / (q / 4.0), 1) end as speed,
  case when line >= 6 then 'Done' when q < 2 then 'Calculating...' when t >= 60 then cast(t // 60 as varchar) || 'm' ||
    case when t % 60 > 0 then ' ' || cast(t % 60 as varchar) || 's' else '' end else cast(t as varchar) || 's' end as eta from p
""")
def n30(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("int").alias("line"), "l_partkey", "l_quantity",
        F.lit(datetime(2024, 1, 1)).alias("start"))
    end = F.timestamp_seconds(F.unix_timestamp("start") + F.col("l_quantity").cast("int") * 15)
    elapsed = F.when(F.col("l_quantity") < 2, 0).otherwise(F.col("l_quantity").cast("int"))
    return rows.select("l_orderkey", "line",
                       dates.run_speed("l_partkey", F.when(F.col("l_quantity") >= 10, F.col("start")), end).alias("speed"),
                       dates.run_eta(F.lit(6), "line", elapsed).alias("eta"))


LABEL_TEXT = base.pick("o_orderkey", "Just Now", "3 Days Ago", "Few Hours Ago", "30+ Days Ago", None, "", "Starts soon")


@query("n33_label_dates", sql="""
select o_orderkey as id, cast(case o_orderkey % 7 when 0 then date '2001-08-02' when 1 then date '2001-07-30' when 2 then date '2001-08-02'
  when 3 then null else o_orderdate end as date) as posted from orders
""")
def n33(spark, folder):
    rows = shared(table(spark, folder, "orders")).selectExpr(
        "o_orderkey as id", f"{LABEL_TEXT} as label", "unix_millis(cast(o_orderdate as timestamp)) as created")
    return rows.select("id", dates.label_date("label", "created", F.lit(NOW)).alias("posted"))


# Classification.

def keyword_sql(text_column: str, classes: dict) -> str:
    """CASE over the classes; every listed keyword is tried."""
    arms = " ".join("when " + " or ".join(f"contains({text_column}, '{w}')" for w in words) + f" then '{name}'"
                    for name, words in classes.items())
    return f"case {arms} end"


YEARS_SQL = "list_min(list_filter(list_transform(" + " || ".join(
    f"regexp_extract_all(body, '{p}', 1)" for p in fixed.YEARS_PATTERNS) + ", lambda x: try_cast(x as int)), lambda x: x between 0 and 30))"

CLASS_SQL = f"""
with t as (select id, lower(title) as head, lower(title) || ' ' || lower(coalesce(description, '')) as body,
    lower(title) || ' ' || lower(coalesce(description, '')) || ' ' || lower(coalesce({{place}}, '')) as spot, description is not null as told from {{table}}),
k as (select *, {YEARS_SQL} as years, {keyword_sql('head', fixed.LEVEL_KEYWORDS)} as by_title, {keyword_sql('body', fixed.LEVEL_KEYWORDS)} as by_text,
    {keyword_sql('body', fixed.JOB_TYPE_KEYWORDS)} as job, {keyword_sql('spot', fixed.REMOTE_KEYWORDS)} as remote from t),
l as (select *, case when by_title is null and by_text is null and years is not null then
    case when years <= 2 then 'entry' when years <= 4 then 'mid' when years <= 7 then 'senior' when years <= 10 then 'lead' else 'staff' end end as by_years from k),
f as (select *, coalesce(by_title, by_text, by_years, 'unknown') as level,
    (case when coalesce(years, 0) <> 0 then 1 else 0 end) + (case when coalesce(by_title, by_text, by_years) is not null then 1 else 0 end)
    + (case when job is not null then 1 else 0 end) + (case when remote is not null then 1 else 0 end) as signals from l)
select id, years as years_required, level as experience_level, coalesce(job, 'unknown') as job_type, coalesce(remote, 'unknown') as remote_type,
  case when level in ('intern', 'entry') then true when level in ('senior', 'lead', 'staff', 'principal', 'executive') then false
    when years is not null then years <= 2 else level = 'unknown' end as entry_friendly, signals as n_signals,
  round(least((case when told then 0.5 else 0.3 end)::double + least(signals * 0.1::double, 0.4::double) + (case when by_title is not null then 0.1::double else 0 end), 1.0::double), 2) as confidence
from f"""

CLASS_COLUMNS = ["id", "class.years_required", "class.experience_level", "class.job_type", "class.remote_type",
                 "class.entry_friendly", "n_signals", "class.confidence"]


@query("c7_classify_jobs", needs="jobs", sql=CLASS_SQL.format(place="location", table="jobs"))
def c7(spark, folder):
    rows = classify.classify(jobs(spark, folder).select("id", "title", "description", "location"))
    return rows.withColumn("n_signals", F.size("class.signals")).select(*CLASS_COLUMNS)


@query("c7_classify_documents", needs="docs", sql=CLASS_SQL.format(place="null", table="docs"))
def c7b(spark, folder):
    rows = classify.classify(docs(spark, folder).select("id", "title", "description"), location=None)
    return rows.withColumn("n_signals", F.size("class.signals")).select(*CLASS_COLUMNS)


@query("c1_years_required", needs="docs", sql=f"select id, {YEARS_SQL} as years from (select id, lower(description) as body from docs)")
def c1(spark, folder):
    return docs(spark, folder).select("id", classify.years_required("description").alias("years"))


@query("c2_level_counts", needs="jobs", sql=f"select experience_level, count(*) as postings from ({CLASS_SQL.format(place='location', table='jobs')}) group by 1")
def c2(spark, folder):
    rows = classify.classify(jobs(spark, folder).select("title", "description", "location"))
    return rows.groupBy("class.experience_level").agg(F.count("*").alias("postings"))


@query("c3_job_type_with_hint", needs="jobs", sql=f"""
select id, coalesce({keyword_sql("lower(job_type)", {k: fixed.JOB_TYPE_KEYWORDS[k] for k in fixed.JOB_TYPE_HINT_ORDER})},
  {keyword_sql("(lower(title) || ' ' || lower(coalesce(description, '')))", fixed.JOB_TYPE_KEYWORDS)}, 'unknown') as kind from jobs
""")
def c3(spark, folder):
    rows = classify.classify(jobs(spark, folder), job_type_hint="job_type")
    return rows.select("id", F.col("class.job_type").alias("kind"))


@query("c4_remote_type_counts", needs="jobs", sql=f"""
select {keyword_sql("(lower(title) || ' ' || lower(coalesce(description, '')) || ' ' || lower(coalesce(location, '')))", fixed.REMOTE_KEYWORDS)} as remote_type, count(*) as postings from jobs group by 1
""")
def c4(spark, folder):
    found = classify.first_keyword(F.lower(F.concat_ws(" ", "title", "description", "location")), fixed.REMOTE_KEYWORDS)
    return jobs(spark, folder).groupBy(F.substring_index(found, "|", 1).alias("remote_type")).agg(F.count("*").alias("postings"))


@query("c5_strict_friendliness", needs="jobs", sql=f"""
select id, case when experience_level = 'unknown' and years_required is null then false else entry_friendly end as strict from ({CLASS_SQL.format(place='location', table='jobs')})
""")
def c5(spark, folder):
    rows = classify.classify(jobs(spark, folder).select("id", "title", "description", "location"), strict_entry=True)
    return rows.select("id", F.col("class.entry_friendly").alias("strict"))


@query("c6_signals", needs="jobs", sql=f"""
with t as (select id, lower(title) as head, lower(title) || ' ' || lower(coalesce(description, '')) as body from jobs),
k as (select id, {YEARS_SQL} as years, {keyword_sql('head', fixed.LEVEL_KEYWORDS)} as by_title, {keyword_sql('body', fixed.LEVEL_KEYWORDS)} as by_text from t)
select id, case when coalesce(years, 0) <> 0 then 'years_required=' || cast(years as varchar) else '' end as years,
  case when by_title is not null then 'title' when by_text is not null then 'desc' when years is not null then 'years' else '' end as level_from,
  case when by_title is null and by_text is null and years is not null then 'years_based=' || case when years <= 2 then 'entry' when years <= 4 then 'mid'
    when years <= 7 then 'senior' when years <= 10 then 'lead' else 'staff+' end || '(' || cast(years as varchar) || ')' else '' end as band from k
""")
def c6(spark, folder):
    rows = classify.classify(jobs(spark, folder).select("id", "title", "description"), location=None)
    one = lambda start: F.array_join(F.filter("class.signals", lambda s: s.startswith(start)), ",")
    origin = F.filter("class.signals", lambda s: s.rlike("^(title|desc)_keyword|^years_based"))
    return rows.select("id", one("years_required").alias("years"),
                       F.regexp_extract(F.array_join(origin, ","), "^(title|desc|years)", 1).alias("level_from"),
                       one("years_based").alias("band"))


@query("c8_strict_entry_rule", needs="jobs", sql="""
with t as (select id, lower(trim(regexp_replace(title, '\\s+', ' ', 'g'))) as head,
  lower(trim(regexp_replace(replace(regexp_replace(coalesce(description, ''), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '\\s+', ' ', 'g'))) as body from jobs)
select id, case when regexp_matches(head, '\\bintern\\b') then true
  when regexp_matches(head, '\\b(senior|head|sr|staff|lead|manager|principal|expert|vp|director|chief|phd)\\b') then false
  when regexp_matches(body, '\\b0-[0-9]*\\+?\\s*years?') then true
  else coalesce(list_min(list_transform(regexp_extract_all(body, '([0-9]+)-[0-9]*\\+?\\s*years?', 1) || regexp_extract_all(body, '([0-9]+)\\s*\\+?\\s*years?', 1),
    lambda x: cast(x as bigint))), 0) <= 1 end as entry_level from t
""")
def c8(spark, folder):
    none = F.lit(None).cast("string")
    return jobs(spark, folder).select("id", classify.is_entry_level_strict("title", "description", none, none).alias("entry_level"))


@query("c9_fill_only_merge", needs="jobs", sql=f"""
select j.id, coalesce(nullif(j.experience_level, ''), c.experience_level) as experience_level, coalesce(nullif(j.job_type, ''), nullif(c.job_type, 'unknown')) as job_type,
  coalesce(nullif(j.remote_type, ''), nullif(c.remote_type, 'unknown')) as remote_type from jobs j join ({CLASS_SQL.format(place='location', table='jobs')}) c on j.id = c.id
""")
def c9(spark, folder):
    rows = classify.fill_from_class(classify.classify(jobs(spark, folder)))
    return rows.select("id", "experience_level", "job_type", "remote_type")


@query("c10_level_from_flags", needs="jobs", sql="""
with t as (select id, lower(title) as t from jobs)
select id, case when contains(t, 'intern') or id % 31 = 0 then 'intern' when contains(t, 'entry') or contains(t, 'new grad') or id % 29 = 0 then 'entry'
  when contains(t, 'junior') or contains(t, 'jr') then 'entry' when contains(t, 'senior') or contains(t, 'sr') then 'senior'
  when contains(t, 'principal') or contains(t, 'staff') then 'lead' when contains(t, 'director') or contains(t, 'vp') then 'executive'
  when id % 5 = 0 then 'senior' end as level from t
""")
def c10(spark, folder):
    key = F.col("id")
    return jobs(spark, folder).select("id", classify.level_from_flags("title", key % 31 == 0, key % 29 == 0, key % 5 == 0).alias("level"))


@query("f20_entry_level_filter", needs="docs", sql=f"""
select id, title from docs where id in (select id from ({CLASS_SQL.format(place='null', table='docs')}) where entry_friendly)
""")
def f20(spark, folder):
    return classify.entry_level_only(docs(spark, folder)).select("id", "title")
