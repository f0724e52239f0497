"""Filters, searches by predicate and bulk lookups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.classify import is_entry_level_strict, relevant_title

REDISTRIBUTABLE = ("approved", "conditional")
UNBOUNDED_SALARY = 750_000


def _both(conditions: Sequence[Column]) -> Column:
    whole = F.lit(True)
    for condition in conditions:
        whole = whole & condition
    return whole


def _contains(column: str, text: str) -> Column:
    """Case-blind containment; `%` and `_` in the text act as wildcards."""
    return F.col(column).ilike(f"%{text}%")


def with_source(jobs: DataFrame, sources: DataFrame) -> DataFrame:
    """Each job with its source's name, type, compliance and activity."""
    attributes = sources.select(
        F.col("id").alias("source_id"), F.col("name").alias("source_name"),
        F.col("scraper_type").alias("source_type"), "compliance_status",
        F.col("base_url").alias("source_url"), F.col("is_active").alias("source_is_active"))
    return jobs.join(attributes, "source_id")


def redistributable_jobs(jobs: DataFrame, sources: DataFrame) -> DataFrame:
    """Active jobs of sources whose terms allow sharing, with attribution."""
    return (
        with_source(jobs.filter("is_active"),
                    sources.filter(F.col("compliance_status").isin(*REDISTRIBUTABLE)))
        .select(*jobs.columns, "source_name", "source_url", "compliance_status")
    )


def search(jobs: DataFrame, sources: DataFrame, *, company: str | None = None,
           location: str | None = None, source_id: int | None = None, active: bool = True,
           redistributable: bool = True, matching: DataFrame | None = None,
           limit: int = 100, offset: int = 0) -> DataFrame:
    """Jobs newest first. `matching` holds the ids a text search found."""
    found = jobs
    if active:
        found = found.filter("is_active")
    if company:
        found = found.filter(_contains("company", company))
    if location:
        found = found.filter(_contains("location", location))
    if source_id is not None:
        found = found.filter(F.col("source_id") == source_id)
    allowed = sources.filter(F.col("compliance_status").isin(*REDISTRIBUTABLE)) if redistributable else sources
    found = found.join(allowed.select(F.col("id").alias("source_id")), "source_id", "left_semi")
    if matching is not None:
        found = found.join(matching.select("id"), "id", "left_semi")
    return found.orderBy(F.col("last_seen_at").desc(), F.col("id").desc()).offset(offset).limit(limit)


def export_select(jobs: DataFrame, sources: DataFrame, *, company: str | None = None,
                  location: str | None = None, source_type: str | None = None,
                  experience_level: str | None = None, job_type: str | None = None,
                  remote_type: str | None = None, posted_after: datetime | None = None,
                  posted_before: datetime | None = None, active_only: bool = True,
                  redistributable_only: bool = True, include_source: bool = True,
                  include_description: bool = False) -> DataFrame:
    """Rows and columns of an export, unordered."""
    conditions = []
    if active_only:
        conditions.append(F.col("is_active"))
    if redistributable_only:
        conditions.append(F.col("compliance_status").isin(*REDISTRIBUTABLE))
    if company:
        conditions.append(_contains("company", company))
    if location:
        conditions.append(_contains("location", location))
    for name, wanted in (("source_type", source_type), ("experience_level", experience_level),
                         ("job_type", job_type), ("remote_type", remote_type)):
        if wanted:
            conditions.append(F.col(name) == wanted)
    if posted_after:
        conditions.append(F.col("first_seen_at") >= F.lit(posted_after))
    if posted_before:
        conditions.append(F.col("first_seen_at") <= F.lit(posted_before))
    columns = [*fixed.EXPORT_COLUMNS, *fixed.EXPORT_KEY_COLUMNS]
    if include_source:
        columns += fixed.EXPORT_SOURCE_COLUMNS
    if include_description:
        columns.append("description")
    return with_source(jobs, sources).filter(_both(conditions)).select(*columns)


def export_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy("company", F.col("first_seen_at").desc(), "id")


def approved_sources(sources: DataFrame) -> DataFrame:
    return sources.filter(F.col("compliance_status").isin(*REDISTRIBUTABLE) & F.col("is_active"))


def list_sources(sources: DataFrame, active_only: bool = True) -> DataFrame:
    return (sources.filter("is_active") if active_only else sources).orderBy("name")


def sources_in_category(sources: DataFrame, category: str, column: str = "category") -> DataFrame:
    return sources.filter(F.lower(column) == category.lower())


def lookup(table: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is asked for; many point lookups as one join."""
    return table.join(keys.select(*on).distinct(), list(on), "left_semi")


def compliance(sources: DataFrame) -> DataFrame:
    """Whether each source may be processed, and why not."""
    status = F.col("compliance_status")
    reason = (F.when(status == "prohibited", "Source is PROHIBITED by terms of service")
              .when(status == "pending_review", "Source compliance is pending review")
              .when(~F.col("is_active"), "Source is not active"))
    return sources.withColumn("reason", reason).withColumn("allowed", F.col("reason").isNull())


def salary_overlap(low: int | None, high: int | None, job_min: str = "salary_min",
                   job_max: str = "salary_max") -> Column:
    """Whether a job's range meets the wanted one; bounds at the ends do not bind."""
    conditions = []
    if low is not None and low > 0:
        conditions.append(F.col(job_max) >= low)
    if high is not None and high < UNBOUNDED_SALARY:
        conditions.append(F.col(job_min) <= high)
    return _both(conditions)


def filter_jobs(jobs: DataFrame, *, companies: Sequence[str] = (), statuses: Sequence[str] = (),
                date_from: datetime | date | None = None, date_to: datetime | date | None = None,
                favorites_only: bool = False, salary_min: int | None = None,
                salary_max: int | None = None, include_archived: bool = False) -> DataFrame:
    """Application tracker filter, without an order."""
    conditions = [salary_overlap(salary_min, salary_max)]
    if companies and "All" not in companies:
        conditions.append(F.col("company").isin(*companies))
    if statuses and "All" not in statuses:
        conditions.append(F.col("application_status").isin(*statuses))
    if date_from:
        conditions.append(F.col("posted_date") >= F.lit(date_from))
    if date_to:
        conditions.append(F.col("posted_date") <= F.lit(date_to))
    if favorites_only:
        conditions.append(F.col("favorite"))
    if not include_archived:
        conditions.append(~F.col("archived"))
    return jobs.filter(_both(conditions))


def recent_jobs(jobs: DataFrame, as_of: datetime, days: int = 7, limit: int | None = None) -> DataFrame:
    """Newest unarchived jobs of the last days; all of them unless a page size is given."""
    since = F.lit(as_of) - F.make_dt_interval(F.lit(days))
    found = (jobs.filter((F.col("posted_date") >= since) & ~F.col("archived"))
             .orderBy(F.col("posted_date").desc(), F.col("id").desc()))
    return found if limit is None else found.limit(limit)


def changed_since(jobs: DataFrame, ids: DataFrame, since: datetime, limit: int | None = None) -> DataFrame:
    """Wanted jobs changed after a moment, newest first; all of them unless a page size is given."""
    found = (jobs.filter(F.col("updated_at") > F.lit(since)).join(ids.select("id"), "id", "left_semi")
             .orderBy(F.col("updated_at").desc(), F.col("id").desc()))
    return found if limit is None else found.limit(limit)


def reject_reason(jobs: DataFrame, *, blocked_companies: Sequence[str] = (),
                  oldest: datetime | None = None, block_list: DataFrame | None = None,
                  duplicates: DataFrame | None = None, remoteness: str = "ANY") -> DataFrame:
    """Add `reject_reason`, null for rows that pass every check of the master list."""
    df = jobs
    empty = F.lit(False)
    for name, keys in (("_blocked", block_list), ("_known", duplicates)):
        if keys is None:
            df = df.withColumn(name, empty)
        else:
            flags = keys.select("key_id").distinct().withColumn(name, F.lit(True))
            df = df.join(flags, "key_id", "left").withColumn(name, F.coalesce(F.col(name), empty))
    old = F.col("post_date") < F.lit(oldest) if oldest else empty
    wrong_place = ((F.col("remoteness") != "UNKNOWN") & (F.col("remoteness") != remoteness)
                   if remoteness != "ANY" else empty)
    reason = (
        F.when(F.col("status").isin(*fixed.MASTER_REMOVE_STATUSES), "status")
        .when(F.col("company").isin(*blocked_companies) if blocked_companies else empty, "company")
        .when(old, "age").when(F.col("_blocked"), "block list")
        .when(F.col("_known"), "duplicate").when(wrong_place, "remoteness")
    )
    return df.withColumn("reject_reason", reason).drop("_blocked", "_known")


def job_filter(jobs: DataFrame, **options) -> DataFrame:
    """Rows of the master list that pass every check."""
    return reject_reason(jobs, **options).filter("reject_reason is null").drop("reject_reason")


def by_kind(jobs: DataFrame, location_type: str | None = None, job_type: str | None = None) -> DataFrame:
    if location_type:
        jobs = jobs.filter(F.col("location_type") == location_type)
    return jobs.filter(F.col("job_type") == job_type) if job_type else jobs


def relevant_jobs(jobs: DataFrame, title: str = "title") -> DataFrame:
    return jobs.filter(relevant_title(title))


def fresh_board_rows(rows: DataFrame, as_of_epoch: int, board: str, base: str, days: int = 14) -> DataFrame:
    """Rows updated within the last days, with first location, link and key."""
    slug = F.lower(F.replace(F.col("title"), F.lit(" "), F.lit("-")))
    return rows.filter(F.col("updated_date") >= as_of_epoch - days * 86400).select(
        F.col("title").alias("job_title"),
        F.coalesce("company_name", F.lit("Unknown Company")).alias("company"),
        F.coalesce(F.get("locations", F.lit(0)), F.lit("Unknown Location")).alias("location"),
        F.concat(F.lit(base), "id", F.lit("/"), slug).alias("url"),
        "updated_date", F.concat(F.lit(f"{board}-"), "id").alias("key"))


def companies_for_language(companies: DataFrame, vacancies: DataFrame, codes: DataFrame, language: str,
                           members_too: bool = False) -> DataFrame:
    """Companies shown for a language: coded, not ignored, with vacancies or a member."""
    stats = vacancies.filter(F.col("language") == language).groupBy("alias").agg(
        F.max("date").alias("latest_vacancy_date"), F.bool_or("remote").alias("_remote"),
        F.count("*").alias("vacancies"))
    shown = F.coalesce(F.col("vacancies"), F.lit(0)) > 0
    if members_too:
        shown = shown | F.col("foundation_member")
    return (
        companies.filter(~F.col("ignore")).drop("id").join(codes, "alias").join(stats, "alias", "left").filter(shown)
        .withColumn("remote", F.col("remote") | F.coalesce("_remote", F.lit(False)))
        .withColumn("vacancies", F.coalesce("vacancies", F.lit(0))).drop("_remote")
    )


def small_company(band: str = "employees") -> Column:
    return ~F.coalesce(F.col(band).isin(*fixed.LARGE_COMPANY_BANDS), F.lit(False))


# Fields each work list wants filled.
PROFILE_FIELDS = {
    "web": ["careers", "about", "blog"],
    "network": ["profile_id", "alias", "profile_name", "followers", "employees"],
}


def missing_profiles(companies: DataFrame, vacancies: DataFrame, fields: Sequence[str],
                     skip_small: bool = True) -> DataFrame:
    """Companies with vacancies and an empty wanted field, newest vacancy first."""
    lacks = F.lit(False)
    for name in fields:
        lacks = lacks | F.coalesce(F.col(name).cast("string").isin("", "0"), F.lit(True))
    latest = vacancies.groupBy("alias").agg(F.max("date").alias("latest_vacancy_date"))
    wanted = companies.filter(~F.col("ignore") & lacks)
    if skip_small:
        wanted = wanted.filter(~small_company())
    return wanted.join(latest, "alias").orderBy(F.col("latest_vacancy_date").desc(), F.col("id").desc())


def active_companies(companies: DataFrame) -> DataFrame:
    return companies.filter("active").select("name").orderBy("name")


def company_extract(companies: DataFrame, vacancies: DataFrame, language: str, sync_source: str,
                    verified: bool = False) -> DataFrame:
    """Companies with vacancies of a language or from a sync source, by name."""
    with_jobs = vacancies.filter(F.col("language") == language).select("alias").distinct().withColumn(
        "_has", F.lit(True))
    shown = F.col("_has").isNotNull() | F.array_contains("sync_sources", sync_source)
    if verified:
        companies = companies.filter(~F.col("ignore") & F.col("github_verified"))
    return (companies.join(with_jobs, "alias", "left").filter(shown)
            .select("name", "website", "github").orderBy(F.lower("name"), "website"))


def entry_level_board_rows(rows: DataFrame, aggregator: str = "Jobs via Dice") -> DataFrame:
    """Drop reposts and one aggregator, keep entry-level rows."""
    empty = F.lit("")
    return rows.filter(
        ~F.coalesce("reposted", F.lit(False)) & ~F.col("company").contains(aggregator)
        & is_entry_level_strict("job_title", "description", empty, empty))
