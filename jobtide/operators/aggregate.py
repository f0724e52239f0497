"""Counts, rates and summaries. Each report is one grouped pass over its input."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def job_totals(jobs: DataFrame) -> DataFrame:
    return jobs.agg(F.count("*").alias("total_jobs"), _count(F.col("is_active")).alias("active_jobs"),
                    F.countDistinct("company").alias("unique_companies"),
                    F.countDistinct("source_id").alias("sources_with_jobs"))


def export_summary(rows: DataFrame, top: int = 10) -> DataFrame:
    """Total, busiest companies and levels of an export as (section, label, jobs).

    One grouped pass feeds all three sections.
    """
    counts = rows.groupBy("company", F.coalesce("experience_level", F.lit("unknown")).alias("level")).agg(
        F.count("*").alias("n"))
    companies = (counts.groupBy("company").agg(F.sum("n").alias("jobs"))
                 .orderBy(F.col("jobs").desc(), "company").limit(top)
                 .select(F.lit("company").alias("section"), F.col("company").alias("label"), "jobs"))
    levels = counts.groupBy("level").agg(F.sum("n").alias("jobs")).select(
        F.lit("level").alias("section"), F.col("level").alias("label"), "jobs")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("jobs")).select(
        F.lit("total").alias("section"), F.lit("all").alias("label"), "jobs")
    return total.unionByName(companies).unionByName(levels)


def run_statistics(processed: DataFrame) -> DataFrame:
    """Per source: scraped, skipped, new, updated and level bands.

    Rows carry `outcome` (skipped, inserted, updated) and `level`.
    """
    level = F.col("level")
    done = F.col("outcome") != "skipped"
    return processed.groupBy("source_id").agg(
        F.count("*").alias("total_scraped"),
        _count(F.col("outcome") == "skipped").alias("duplicates_skipped"),
        _count(F.col("outcome") == "inserted").alias("new_jobs"),
        _count(F.col("outcome") == "updated").alias("updated_jobs"),
        _count(done & level.isin("entry", "intern")).alias("entry_level"),
        _count(done & (level == "mid")).alias("mid_level"),
        _count(done & level.isin("senior", "lead", "staff", "principal")).alias("senior_level"))


def batch_statistics(runs: DataFrame) -> DataFrame:
    """Totals over runs, with the share of runs free of errors."""
    return runs.agg(
        F.count("*").alias("sources"), F.sum("total_scraped").alias("total_scraped"),
        F.sum("new_jobs").alias("new_jobs"), F.sum("duplicates_skipped").alias("duplicates_skipped"),
        _count(F.col("error").isNotNull()).alias("failed"),
        F.round(100.0 * _count(F.col("error").isNull()) / F.count("*"), 2).alias("success_rate"))


def daily_trend(jobs: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Unarchived postings per day of the last days."""
    since = F.date_sub(F.to_date(F.lit(as_of)), days)
    return (jobs.filter((F.col("posted_date") >= since) & ~F.col("archived"))
            .groupBy(F.to_date("posted_date").alias("day")).agg(F.count("*").alias("job_count")))


def trend_totals(trend: DataFrame, days: int) -> DataFrame:
    total = F.coalesce(F.sum("job_count"), F.lit(0))
    return trend.agg(total.alias("total_jobs"), F.round(total / days, 4).alias("daily_average"))


def company_hiring(jobs: DataFrame, companies: DataFrame, top: int = 20) -> DataFrame:
    """Busiest companies with average salary bounds and the last posting."""
    per_company = jobs.filter(~F.col("archived")).groupBy("company_id").agg(
        F.count("*").alias("n"), F.sum("salary_min").alias("s0"), F.count("salary_min").alias("c0"),
        F.sum("salary_max").alias("s1"), F.count("salary_max").alias("c1"),
        F.max("posted_date").alias("last"))
    named = per_company.join(companies.select(F.col("id").alias("company_id"), "name"), "company_id")
    mean = lambda s, c: F.round(F.try_divide(F.sum(s), F.sum(c)), 2)
    return (named.groupBy(F.col("name").alias("company")).agg(
        F.sum("n").alias("total_jobs"), mean("s0", "c0").alias("avg_min_salary"),
        mean("s1", "c1").alias("avg_max_salary"), F.max("last").alias("last_job_posted"))
        .orderBy(F.col("total_jobs").desc(), "company").limit(top))


def salary_statistics(jobs: DataFrame, as_of: datetime, days: int = 90) -> DataFrame:
    """Count, averages, bounds and spread of recent salaries; zero where unknown."""
    since = F.date_sub(F.to_date(F.lit(as_of)), days)
    rows = jobs.filter((F.col("posted_date") >= since) & ~F.col("archived") & F.col("salary_min").isNotNull())
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    low, high = F.avg("salary_min"), F.avg("salary_max")
    return rows.agg(
        F.count("*").alias("total_jobs_with_salary"), zero(F.round(low, 2)).alias("avg_min_salary"),
        zero(F.round(high, 2)).alias("avg_max_salary"),
        zero(F.min("salary_min").cast("double")).alias("min_salary"),
        zero(F.max("salary_max").cast("double")).alias("max_salary"),
        zero(F.round(F.stddev_samp("salary_min"), 2)).alias("salary_std_dev"),
        zero(F.round((low + high) / 2, 2)).alias("midpoint"))


def status_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("application_status").agg(F.count("*").alias("jobs"))


def sync_statistics(jobs: DataFrame) -> DataFrame:
    return jobs.agg(
        F.count("*").alias("total_jobs"), _count(~F.col("archived")).alias("active_jobs"),
        _count(F.col("archived")).alias("archived_jobs"), _count(F.col("favorite")).alias("favorited_jobs"),
        _count(F.col("application_status") != "New").alias("applied_jobs"))


def company_rollup(companies: DataFrame, jobs: DataFrame) -> DataFrame:
    """Every company with its number of jobs, unarchived jobs and last posting."""
    counts = jobs.groupBy("company_id").agg(
        F.count("*").alias("total_jobs"), _count(~F.col("archived")).alias("active_jobs"),
        F.max("posted_date").alias("last_job_posted"))
    return (companies.select(F.col("id").alias("company_id"), "name").join(counts, "company_id", "left")
            .withColumn("total_jobs", F.coalesce("total_jobs", F.lit(0)))
            .withColumn("active_jobs", F.coalesce("active_jobs", F.lit(0))))


def company_activity(companies: DataFrame) -> DataFrame:
    return companies.agg(F.count("*").alias("total"), _count(F.col("active")).alias("active"),
                         _count(~F.col("active")).alias("inactive"))


def monthly_costs(costs: DataFrame, month: datetime, budget: float) -> DataFrame:
    """Cost and operations per service of a month, with the budget's state on each row."""
    end = F.add_months(F.lit(month), 1)
    rows = costs.filter((F.col("timestamp") >= F.lit(month)) & (F.col("timestamp") < end))
    services = rows.groupBy("service").agg(F.sum("cost_usd").alias("cost"), F.count("*").alias("operations"))
    total = services.agg(F.coalesce(F.sum("cost"), F.lit(0.0))).scalar()
    used = total / budget
    status = (F.when(used >= 1.0, "over_budget").when(used >= 0.8, "approaching_limit")
              .when(used >= 0.6, "moderate_usage").otherwise("within_budget"))
    return services.select(
        "service", F.round("cost", 2).alias("cost"), "operations", F.round(total, 2).alias("total_cost"),
        F.round(F.lit(budget) - total, 2).alias("remaining"),
        F.round(used * 100, 2).alias("utilization_percent"), status.alias("budget_status"),
        F.when(status == "over_budget", "error").when(status == "approaching_limit", "warning").alias("alert"))


def view_totals(daily: DataFrame, since: datetime, key: str, value: str = "views") -> DataFrame:
    """Views per entity, in all and since a day."""
    recent = F.when(F.col("day") >= F.to_date(F.lit(since)), F.col(value)).otherwise(0)
    return daily.groupBy(key).agg(F.sum(value).alias("total"), F.sum(recent).alias("since"))


def favorite_totals(state: DataFrame, since: datetime, key: str, value: str = "active") -> DataFrame:
    """Users who favour each entity, in all and those who began since a day."""
    began = F.to_date("created_at") >= F.to_date(F.lit(since))
    return state.filter(value).groupBy(key).agg(F.count("*").alias("total"), _count(began).alias("since"))


def views_since(daily: DataFrame, since: datetime, key: str, value: str = "views") -> DataFrame:
    return (daily.filter(F.col("day") >= F.to_date(F.lit(since))).groupBy(key)
            .agg(F.sum(value).alias("count")))


def running_counters(events: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """Views per entity and day."""
    return events.groupBy(key, F.to_date(ts).alias("day")).agg(F.count("*").alias("views"))


def net_subscribers(changes: DataFrame, key: str, value: str = "active") -> DataFrame:
    """Subscribers per entity from real changes: one up or one down each."""
    return changes.groupBy(key).agg(F.sum(F.when(F.col(value), 1).otherwise(-1)).alias("user_count"))


def unique_viewers(events: DataFrame, key: str, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Different viewers per entity and day; equal views combine before the shuffle."""
    seen = events.groupBy(key, F.to_date(ts).alias("day"), user).agg(F.lit(1).alias("one"))
    return seen.groupBy(key, "day").agg(F.count("*").alias("viewers"))


def active_users(events: DataFrame, unit: str, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Different users per hour or day."""
    seen = events.groupBy(F.date_trunc(unit, ts).alias(unit), user).agg(F.lit(1).alias("one"))
    return seen.groupBy(unit).agg(F.count("*").alias("users"))


def latest_vacancies(vacancies: DataFrame, *keys: str) -> DataFrame:
    return vacancies.groupBy(*keys).agg(F.max("date").alias("latest_vacancy_date"),
                                        F.bool_or("remote").alias("any_remote"))


def language_stats(vacancies: DataFrame) -> DataFrame:
    """Per company the languages with vacancies and the last date of each.

    Dates are reduced first, so an array holds one entry per language.
    """
    last = vacancies.groupBy("alias", "language").agg(F.max("date").alias("max_vacancy_date"))
    return last.groupBy("alias").agg(
        F.array_sort(F.collect_list(F.struct("language", "max_vacancy_date"))).alias("languages"))


def location_frequency(rows: DataFrame, location: str = "location", least: int = 3) -> DataFrame:
    return (rows.filter(F.col(location) != "").groupBy(location).agg(F.count("*").alias("uses"))
            .filter(F.col("uses") >= least).orderBy(F.col("uses").desc(), location))


def category_counts(rows: DataFrame, category: str) -> DataFrame:
    return rows.groupBy(category).agg(F.count("*").alias("rows"))


def scrape_quality(results: DataFrame, outcome: str = "outcome") -> DataFrame:
    return results.agg(*[_count(F.col(outcome) == o).alias(o)
                         for o in ("processed", "failed", "missed", "skipped")])


def index_coverage(jobs: DataFrame, indexed: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Share of the jobs that the search index holds, and the last one's date."""
    inside = indexed.select(F.col(doc).alias("id")).distinct().withColumn("_in", F.lit(True))
    held = F.col("_in").isNotNull()
    return jobs.join(inside, "id", "left").agg(
        F.count("*").alias("total_jobs"), _count(held).alias("indexed_jobs"),
        F.round(F.coalesce(F.try_divide(100.0 * _count(held), F.count("*")), F.lit(0.0)), 2).alias("coverage"),
        F.max(F.when(held, F.col("posted_date"))).alias("last_updated"))


def view_counts(jobs: DataFrame) -> DataFrame:
    return jobs.agg(F.count("*").alias("all_jobs"), _count(F.col("favorite")).alias("favorites"),
                    _count(F.col("application_status") == "Applied").alias("applied"))
