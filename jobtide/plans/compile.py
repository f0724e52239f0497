"""Multi-site compile: merge, complete the salary, order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.salary import extract_salary_interval, yearly_amount
from ..sources.sites import merge_sites


def compile_sites(*frames: DataFrame, from_description: bool = True, annual: bool = False) -> DataFrame:
    """One table of all sites. Missing salaries are read from the description;
    `annual` turns full pay ranges into yearly amounts."""
    df = merge_sites(*frames, order=False)
    direct = F.col("interval").isNotNull() | F.col("min_amount").isNotNull()
    if annual:
        convert = direct & (F.col("interval") != "yearly") & (F.col("min_amount") != 0) & (F.col("max_amount") != 0)
        yearly = {c: F.when(convert, yearly_amount(c, "interval")).otherwise(F.col(c))
                  for c in ("min_amount", "max_amount")}
        df = df.withColumns({**yearly, "interval": F.when(convert, "yearly").otherwise(F.col("interval"))})
    if from_description:
        df = df.withColumn("_s", F.when(~direct, extract_salary_interval("description", annual)))
        take = F.col("_s").isNotNull()
        df = df.withColumns({c: F.when(take, F.col(f"_s.{c}")).otherwise(F.col(c))
                             for c in ("interval", "min_amount", "max_amount", "currency")})
        source = F.when(take, "description").when(F.col("min_amount") != 0, "direct_data")
        df = df.withColumn("salary_source", source).drop("_s")
    return df.orderBy("site", F.col("date_posted").desc(), "id")
