"""Joins between postings, companies, aliases and activity.

No join here carries a broadcast hint: Catalyst broadcasts a side only when its
measured size is under the session's threshold, and AQE splits skewed keys.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def jobs_with_company(jobs: DataFrame, companies: DataFrame, how: str = "left") -> DataFrame:
    """Company name from the company table, else the name on the posting."""
    names = companies.select(F.col("id").alias("company_id"), F.col("name").alias("_name"))
    return (jobs.join(names, "company_id", how)
            .withColumn("company", F.coalesce("_name", "company")).drop("_name"))


def matched_rows(hits: DataFrame, jobs: DataFrame, doc: str = "doc_id", key: str = "id") -> DataFrame:
    """Search hits with the columns of the rows they point at."""
    return hits.join(jobs.withColumnRenamed(key, doc), doc)


def present(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return rows.join(keys.select(on), on, "left_semi")


def absent(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return rows.join(keys.select(on), on, "left_anti")


def coded(rows: DataFrame, codes: DataFrame, on: str) -> DataFrame:
    """Rows whose alias or URL has a code; the rest are dropped."""
    return rows.join(codes, on)


def resolve_aliases(wanted: DataFrame, companies: DataFrame) -> DataFrame:
    """Company of each wanted alias: a current alias first, else a former one.

    `moved_to` holds the current alias when a former one was asked for.
    """
    names = companies.select(F.col("alias").alias("current"), F.col("alias").alias("asked"),
                             F.lit(1).alias("rank"))
    former = companies.select(F.col("alias").alias("current"),
                              F.explode("previous_aliases").alias("asked"), F.lit(2).alias("rank"))
    best = names.unionByName(former).groupBy("asked").agg(
        F.min(F.struct("rank", "current")).alias("_b"))
    return (wanted.join(best.withColumnRenamed("asked", "alias"), "alias")
            .select("alias", F.col("_b.current").alias("company_alias"),
                    F.when(F.col("_b.rank") == 2, F.col("_b.current")).alias("moved_to")))


def followed_companies(bridge: DataFrame, companies: DataFrame) -> DataFrame:
    """Active user-company links, latest change first per user."""
    return (bridge.filter("active").join(companies, "company_id")
            .orderBy("user_id", F.col("updated_at").desc(), "company_id"))


def enrich_vacancies(vacancies: DataFrame, favorites: DataFrame, daily_views: DataFrame,
                     since: date) -> DataFrame:
    """Vacancies with the user's favourite flag and their views since a day."""
    flags = favorites.filter("favorite").select("vacancy_id").distinct().withColumn("favorite", F.lit(True))
    views = (daily_views.filter(F.col("day") >= F.lit(since)).groupBy("vacancy_id")
             .agg(F.sum("views").alias("monthly_views")))
    return (
        vacancies.join(flags, "vacancy_id", "left").join(views, "vacancy_id", "left")
        .withColumn("favorite", F.coalesce("favorite", F.lit(False)))
        .withColumn("monthly_views", F.coalesce("monthly_views", F.lit(0)))
    )
