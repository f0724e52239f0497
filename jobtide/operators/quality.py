"""Data-quality checks that yield a table of violations or repaired rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import blank, strip

# Longest text per field of jobs, sources and extracted postings.
JOB_LENGTHS = {"title": 500, "company": 255, "location": 500, "url": 2000, "salary_currency": 3,
               "job_type": 50, "experience_level": 50, "remote_type": 50, "external_id": 255}
SOURCE_LENGTHS = {"name": 255, "base_url": 2000, "scraper_type": 100}
POSTING_LENGTHS = {"title": 200, "company": 100, "location": 100, "salary_text": 100,
                   "employment_type": 50, "description": 5000, "url": 500, "posted_date": 50}

# Accepted codes.
COMPLIANCE = ["approved", "conditional", "prohibited", "pending_review"]
LEVELS = ["entry", "mid", "senior", "lead", "executive"]
JOB_TYPES = ["full-time", "part-time", "contract", "internship", "temporary"]


def violations(df: DataFrame, checks: Mapping[str, Column], key: str = "id") -> DataFrame:
    """One row per row and failed check. All checks run in one pass."""
    failed = F.array_compact(F.array(*[
        F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in checks.items()]))
    return df.select(key, F.explode(failed).alias("problem"))


def _empty(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) == ""


def job_field_checks(jobs: DataFrame) -> DataFrame:
    """Required fields and lengths of jobs."""
    checks = {f"{c} missing": _empty(c) for c in ("title", "company", "url")}
    checks |= {f"{c} too long": F.length(c) > n for c, n in JOB_LENGTHS.items() if c in jobs.columns}
    return violations(jobs, checks)


def source_field_checks(sources: DataFrame) -> DataFrame:
    """Required fields, lengths and rate limits of sources."""
    checks = {f"{c} missing": _empty(c) for c in ("name", "base_url")}
    checks |= {f"{c} too long": F.length(c) > n for c, n in SOURCE_LENGTHS.items()}
    checks["rate limit requests out of range"] = ~F.col("rate_limit_requests").between(1, 1000)
    checks["rate limit period out of range"] = ~F.col("rate_limit_period").between(1, 3600)
    checks["compliance unknown"] = ~F.col("compliance_status").isin(*COMPLIANCE)
    return violations(sources, checks)


def allowed_value_checks(jobs: DataFrame) -> DataFrame:
    return violations(jobs, {
        "experience_level unknown": ~F.col("experience_level").isin(*LEVELS),
        "job_type unknown": ~F.col("job_type").isin(*JOB_TYPES)})


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return df.filter(present).groupBy(*keys).agg(F.count("*").alias("uses")).filter("uses > 1")


def orphans(jobs: DataFrame, sources: DataFrame) -> DataFrame:
    """Jobs whose source does not exist."""
    return jobs.join(sources.select(F.col("id").alias("source_id")), "source_id", "left_anti")


def valid_master_rows(rows: DataFrame, least_description: int = 5) -> DataFrame:
    """Rows with key, title, company, URL and a description worth the name."""
    good = F.length("description") >= least_description
    for c in ("key_id", "title", "company", "url"):
        good = good & (F.coalesce(F.col(c), F.lit("")) != "")
    return rows.filter(good)


def tracker_row_checks(jobs: DataFrame) -> DataFrame:
    return violations(jobs, {
        "link blank": blank("link"), "title blank": blank("title"),
        "content hash blank": blank("content_hash"),
        "content hash not 32 long": ~blank("content_hash") & (F.length("content_hash") != 32),
    })


def ordered_salary(jobs: DataFrame, low: str = "salary_min", high: str = "salary_max") -> DataFrame:
    """Trim link and title and put the salary pair in order."""
    swap = F.coalesce(F.col(low) > F.col(high), F.lit(False))
    return (jobs.withColumn("link", strip("link")).withColumn("title", strip("title"))
            .withColumns({low: F.when(swap, F.col(high)).otherwise(F.col(low)),
                          high: F.when(swap, F.col(low)).otherwise(F.col(high))}))


def vacancy_checks(vacancies: DataFrame, key: str = "id") -> DataFrame:
    return violations(vacancies, {
        "title empty": _empty("title"), "url empty": _empty("url")}, key)


def _bad_url(c: str) -> Column:
    """Text that no URL reader accepts: control characters, a bad escape or an empty scheme."""
    return (F.coalesce(F.col(c), F.lit("")) != "") & (
        F.col(c).rlike(r"[\x00-\x1F\x7F]") | F.col(c).rlike(r"%(?:[^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|.?$)")
        | F.col(c).rlike(r"^:") | F.col(c).rlike(r"^[a-z]+://[^/]* "))


def company_checks(companies: DataFrame, urls: Sequence[str] = ("website", "careers", "about", "blog")) -> DataFrame:
    checks = {f"{c} empty": _empty(c) for c in ("name", "alias", "profile_name")}
    checks |= {f"{c} not a URL": _bad_url(c) for c in urls}
    return violations(companies, checks)


def uncoded_aliases(mapped: DataFrame, codes: DataFrame) -> DataFrame:
    """Mapped aliases that have no code."""
    return mapped.join(codes.select("alias"), "alias", "left_anti")


def extracted_posting_checks(rows: DataFrame) -> DataFrame:
    """Length bounds and blank fields of extracted postings."""
    checks = {f"{c} blank": blank(c) for c in ("title", "company", "location", "description")}
    checks |= {f"{c} too long": F.length(c) > n for c, n in POSTING_LENGTHS.items()}
    checks["description too short"] = F.length("description") < 50
    return violations(rows, checks)


def repaired_url(c: str = "url") -> Column:
    """Give links without a scheme the secure one."""
    return F.when(F.col(c).rlike("^https?://") | (F.coalesce(F.col(c), F.lit("")) == ""), F.col(c)).otherwise(
        F.concat(F.lit("https://"), F.col(c)))
