"""Job data derived from the given tables, once for Spark and once as SQL text.

Both sides use the same column expressions, so a query and its SQL twin start
from equal rows. What a query then does with them is written twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import content_hash
from ..session import configure, shared

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, needs: str = "") -> Callable[[Query], Query]:
    """Register a query and its SQL twin; `needs` lists the derived tables the SQL reads."""
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_tables(sql, needs.split())
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(expr: str, *values: str | None) -> str:
    """CASE that spreads values over the remainders of an expression."""
    arms = " ".join(f"when {i} then " + ("null" if v is None else "'" + v.replace("'", "''") + "'")
                    for i, v in enumerate(values))
    return f"case {expr} % {len(values)} {arms} end"


K = "o_orderkey"
JOBS = {
    "id": K, "seq": K, "source_id": "o_custkey % 20", "company_id": "o_custkey",
    "external_id": f"'x' || cast({K} % 7000 as string)",
    "title": pick(K, "Sr. SWE", "junior dev", "Staff SRE", "ml eng", "vp of engineering", "QA Analyst II",
                  "Software Engineering Intern", "  Data   Engineer", "tpm, payments", "Lead iOS Developer",
                  "Principal Researcher", "Support Associate (part-time)", "Machine Learning Engineer"),
    "company": "c_name || " + pick("o_custkey", "", ", Inc.", " LLC", " Ltd", " Corp"),
    "location": pick(K, "SF, CA", "Remote - US", "London, UK", "New York, NY", "Austin, TX, United States",
                     "Hybrid / Seattle", "berlin", "Toronto, Canada", "remote", "LA/California",
                     "Vancouver, Washington, Canada", "Canada - Ottawa", "Work From Home, st. paul, minnesota", None, ""),
    "url": f"'https://www.Board.example/Jobs/' || cast({K} % 9000 as string) || '/?utm_source=feed&team=' || cast({K} % 3 as string) || '&ref=a#top'",
    "description": f"""case {K} % 9
      when 0 then 'Looking for ' || cast({K} % 14 as string) || '+ years of experience in Python. Pay: $' || cast(60 + {K} % 50 as string) || ',000 - $' || cast(110 + {K} % 70 as string) || ',000 per year.'
      when 1 then 'Great opportunity for new graduates. No experience required. Write to jobs' || cast({K} % 100 as string) || '@example.com or hr@example.org today.'
      when 2 then 'Minimum of ' || cast({K} % 12 as string) || ' years. Hybrid work. $' || cast(20 + {K} % 30 as string) || ' - $' || cast(50 + {K} % 40 as string) || ' per hour'
      when 3 then 'Remote position. Work from anywhere. Contract role, ' || cast({K} % 6 as string) || '-' || cast({K} % 6 + 3 as string) || ' years experience.'
      when 4 then '<p>Full-time &amp; permanent</p> <b>At least ' || cast({K} % 9 as string) || ' yrs</b>&nbsp;in office &lt;here&gt;'
      when 5 then 'Plain text about databases, streaming and spark clusters number ' || cast({K} % 400 as string)
      when 6 then 'Part time seasonal help. 100,000 - 150,000 USD'
      when 7 then 'Pay range: $' || cast(80 + {K} % 9 as string) || 'k - $' || cast(100 + {K} % 30 as string) || 'k annually, internship possible'
      else null end""",
    "salary_min": f"case when {K} % 7 = 0 then null else cast(floor(o_totalprice) as int) end",
    "salary_max": f"case when {K} % 7 = 0 then null else cast(floor(o_totalprice * 1.3) as int) end",
    "pay_period": pick(K, "per hour", "Monthly", "yearly", None, "3 days", "wk"),
    "salary_currency": pick(K, "USD", "EUR", "GBP", "cad", "XYZ", None),
    "posted_date": "cast(o_orderdate as timestamp)",
    "first_seen_at": "cast(o_orderdate as timestamp)",
    "last_seen_at": f"cast(o_orderdate as timestamp) + case {K} % 4 when 0 then interval 1 days when 1 then interval 7 days when 2 then interval 30 days else interval 60 days end",
    "created_at": "cast(o_orderdate as timestamp)", "updated_at": "cast(o_orderdate as timestamp)",
    "is_active": f"{K} % 6 <> 0", "archived": f"{K} % 11 = 0", "favorite": f"{K} % 13 = 0",
    "notes": f"case when {K} % 17 = 0 then 'call back' else ' ' end",
    "application_status": "case o_orderstatus when 'O' then 'New' when 'F' then 'Applied' else 'Interested' end",
    "application_date": f"case when o_orderstatus = 'F' and {K} % 2 = 0 then cast(o_orderdate as timestamp) + interval 3 days end",
    "job_type": pick(K, "full-time", "part-time", "contract", "internship", None),
    "experience_level": pick(K, "entry", "mid", "senior", None, "lead", "executive", None, "guru"),
    "remote_type": pick(K, "remote", "hybrid", None, "onsite", None, ""),
    "link": f"'https://jobs.example/' || cast({K} as string)",
    "last_seen": f"cast(o_orderdate as timestamp) + case {K} % 4 when 0 then interval 1 days when 1 then interval 7 days when 2 then interval 30 days else interval 60 days end",
}

S = "cast(substr(source, 4) as bigint)"
SOURCES = {
    "id": S, "name": "source || '_board'", "base_url": f"'https://' || source || '.example'",
    "scraper_type": pick(S, "greenhouse", "lever", "ashby", "amazon_jobs"),
    "compliance_status": pick(S, "approved", "conditional", "prohibited", "pending_review", "approved"),
    "is_active": f"{S} % 6 <> 0", "category": pick(S, "ATS", "direct", "Api"),
    "rate_limit_requests": f"{S} * 60", "rate_limit_period": f"{S} + 55",
}

C = "c_custkey"
COMPANIES = {
    "id": C, "name": "c_name", "active": "c_acctbal > 0", "alias": f"'company-' || cast({C} as string)",
    "second_alias": f"case {C} % 6 when 0 then '' when 1 then 'company-' || cast({C} as string) || '-inc' when 2 then 'Company' || cast({C} as string) when 3 then 'company.' || cast({C} as string) || 'labs' when 4 then 'other-' || cast({C} as string) else 'company' || cast({C} as string) || 'ai' end",
    "old_alias": f"'old-' || cast({C} % 700 as string)",
    "ignore": f"{C} % 17 = 0", "foundation_member": f"{C} % 19 = 0", "github_verified": f"{C} % 3 = 0",
    "remote": f"{C} % 23 = 0", "employees": pick(C, "10K+", "11-50", "51-200", "2-10", "1K-5K", ""),
    "website": f"case when {C} % 29 = 0 then 'https://bad%zz.example' else 'https://www.c' || cast({C} as string) || '.example:8080/about?x=1#y' end",
    "careers": pick(C, "https://careers.example", "", "https://jobs.example"),
    "about": pick(C, "https://about.example", None, "https://us.example", ""),
    "blog": f"case when {C} % 4 = 0 then 'https://blog.example' else 'https://news.example' end",
    "profile_name": f"case when {C} % 31 = 0 then '' else upper(c_name) end",
    "github": f"'gh' || cast({C} as string)",
    "pinned": f"{C} % 37 = 0",
}
CODES = {"alias": f"'company-' || cast({C} as string)", "id": f"{C} + 1"}

LANGUAGES = ["go", "rust", "scala", "python", "ruby"]
VACANCIES = {
    "id": K, "seq": K, "alias": "'company-' || cast(o_custkey as string)", "language": pick(K, *LANGUAGES),
    "title": f"case when {K} % 97 = 0 then '' else {JOBS['title']} end",
    "url": f"case when {K} % 89 = 0 then '' else 'https://v.example/' || cast({K} % 11000 as string) end",
    "date": "cast(o_orderdate as date)", "remote": f"{K} % 9 = 0",
    "location": f"coalesce({JOBS['location']}, '')",
    "short_description": pick(K, "Build things", "", "Run things"), "switching": pick(K, "", "Visa help", "Move paid", ""),
    "ignore": "o_custkey % 17 = 0",
}

VIEWS = {
    "event_id": "event_id", "ts": "cast(ts as timestamp)", "user_id": "user_id",
    "entity": "cast(regexp_extract(props, '([0-9]+)', 1) as bigint)", "event_type": "event_type", "value": "value",
}

DOCS = {
    "id": "doc_id", "seq": "doc_id", "source_id": S, "key_id": "'d' || cast(doc_id as string)", "lang": "lang",
    "description": """case doc_id % 5
      when 0 then cast(doc_id % 13 as string) || '+ years of experience required. ' || text
      when 1 then 'Pay: $' || cast(50 + doc_id % 60 as string) || ',000 - $' || cast(120 + doc_id % 60 as string) || ',000 per year. ' || text
      else text end""",
    "title": pick("doc_id", "Senior Data Engineer", "Data Analyst", "Intern, Platform", "ML Engineer"),
    "text": "text",
}


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} as {n}" for n, e in columns.items())


def jobs(spark: SparkSession, folder: str) -> DataFrame:
    return _jobs_of(table(spark, folder, "orders"), spark, folder)


def heavy_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """Jobs for queries that spend their time on each row."""
    return _jobs_of(shared(table(spark, folder, "orders")), spark, folder)


def heavy_docs(spark: SparkSession, folder: str) -> DataFrame:
    return shared(table(spark, folder, "documents")).selectExpr(*[f"{e} as {n}" for n, e in DOCS.items()])


def _jobs_of(orders: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    rows = orders.join(
        table(spark, folder, "customer").selectExpr("c_custkey as o_custkey", "c_name"), "o_custkey")
    return rows.selectExpr(*[f"{e} as {n}" for n, e in JOBS.items()]).withColumn(
        "content_hash", content_hash("title", "company", "location"))


def _derived(name: str, columns: dict[str, str]) -> Query:
    def build(spark: SparkSession, folder: str) -> DataFrame:
        return table(spark, folder, name).selectExpr(*[f"{e} as {n}" for n, e in columns.items()])

    return build


companies = _derived("customer", COMPANIES)
vacancies = _derived("orders", VACANCIES)
views = _derived("events", VIEWS)
docs = _derived("documents", DOCS)


def codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of two companies out of three."""
    return table(spark, folder, "customer").filter("c_custkey % 3 <> 0").selectExpr(
        *[f"{e} as {n}" for n, e in CODES.items()])


def sources(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("source").distinct()
    return rows.selectExpr(*[f"{e} as {n}" for n, e in SOURCES.items()])


STRICT_HASH = "sha256(lower(title) || '|' || lower(company) || '|' || lower(coalesce(location, '')))"
TABLES = {
    "jobs": f"select *, {STRICT_HASH} as content_hash from (select {_select(JOBS)} from orders "
            "join customer on o_custkey = c_custkey)",
    "sources": f"select {_select(SOURCES)} from (select distinct source from documents)",
    "companies": f"select {_select(COMPANIES)} from customer",
    "codes": f"select {_select(CODES)} from customer where c_custkey % 3 <> 0",
    "vacancies": f"select {_select(VACANCIES)} from orders",
    "views": f"select {_select(VIEWS)} from events",
    "docs": f"select {_select(DOCS)} from documents",
}


def with_tables(sql: str, names: list[str]) -> str:
    """SQL with the derived tables it needs put in front."""
    parts = [f"{n} as ({TABLES[n]})" for n in names]
    text = sql.strip()
    for opening in ("with recursive ", "with "):
        if text.lower().startswith(opening):
            parts.append(text[len(opening):])
            return opening + ", ".join(parts)
    return ("with " + ", ".join(parts) + " " if parts else "") + text
