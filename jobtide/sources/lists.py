"""Job lists and pages: HTML tables, Markdown tables, posting pages, nested profiles.

Each page is taken apart inside its own row with array functions; only the company that
a row takes over from the rows above is looked up along the rows of its page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import plain_text, strip_html

CARRY = "↳"
CLOSED, NO_SPONSOR, CITIZEN, TOP_COMPANY, DEGREE = "🔒", "🛂", "🇺🇸", "🔥", "🎓"


def _cells(row: Column) -> Column:
    return F.transform(F.regexp_extract_all(row, F.lit(r"(?s)<td[^>]*>(.*?)</td>"), F.lit(1)), lambda p: F.trim(p))


def _label(cell: Column) -> Column:
    """Cell text without tags and legend marks."""
    marks = "|".join([CLOSED, NO_SPONSOR, CITIZEN, TOP_COMPANY, DEGREE])
    return F.trim(F.regexp_replace(F.regexp_replace(strip_html(cell), marks, ""), r"\s+", " "))


def _carry_company(rows: DataFrame) -> DataFrame:
    """Give rows marked as continued the company of the last row above that has its own."""
    above = Window.partitionBy("_page").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.when(~F.col("company").contains(CARRY), F.col("company"))
    return rows.withColumn("company", F.coalesce(F.last(own, ignorenulls=True).over(above), "company")).drop("_page")


def ingest_job_lists(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Rows of five-cell HTML tables.

    One output row per role with an array of locations and flags from the legend.
    """
    rows = F.regexp_extract_all(F.col(html), F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    whole = F.filter(rows, lambda r: F.size(_cells(r)) >= 5)
    entries = F.transform(whole, lambda r, i: F.struct(
        i.alias("pos"), _label(_cells(r)[0]).alias("company"), _cells(r).alias("cells"), r.alias("whole")))
    df = _carry_company(pages.withColumn("_page", F.monotonically_increasing_id()).select(key, "_page", F.inline(entries)))
    cell = lambda i: F.col("cells")[i]
    places = F.filter(F.transform(F.split(F.regexp_replace(
        cell(2), r"(?is)</?details>|<summary>.*?</summary>", ""), r"(?i)</?br\s*/?>"), _label), lambda p: p != "")
    return df.select(
        key, "pos", "company", _label(cell(1)).alias("role"), places.alias("locations"),
        F.nullif(F.regexp_extract(cell(3), r'href="([^"]+)"', 1), F.lit("")).alias("apply_url"),
        _label(cell(4)).alias("age"), F.col("whole").contains(CLOSED).alias("closed"),
        F.col("whole").contains(NO_SPONSOR).alias("no_sponsorship"),
        F.col("whole").contains(CITIZEN).alias("citizens_only"))


def ingest_markdown_lists(texts: DataFrame, key: str = "page_id", text: str = "text") -> DataFrame:
    """Rows of five-column Markdown tables, heads and rules left out."""
    lines = F.filter(F.split(F.col(text), r"\r?\n"), lambda x: x.startswith("|"))
    cells = F.transform(lines, lambda x: F.transform(
        F.split(F.regexp_replace(F.regexp_replace(x, r"^\|", ""), r"\|\s*$", ""), r"\|"), lambda p: F.trim(p)))
    body = F.filter(cells, lambda c: (F.size(c) >= 5) & (c[0] != "Company") & ~c[0].rlike(r"^:?-+:?$"))
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(
        c, r"\[([^\]]*)\]\([^)]*\)", "$1"), r"\*\*|🔒|🛂|🇺🇸", ""))
    entries = F.transform(body, lambda c, i: F.struct(
        i.alias("pos"), plain(c[0]).alias("company"), c.alias("cells"), F.array_join(c, "|").alias("whole")))
    df = _carry_company(texts.withColumn("_page", F.monotonically_increasing_id()).select(key, "_page", F.inline(entries)))
    cell = lambda i: F.col("cells")[i]
    return df.select(
        key, "pos", "company", plain(cell(1)).alias("role"),
        F.filter(F.transform(F.split(cell(2), r"(?i)</?br\s*/?>"), lambda p: F.trim(p)), lambda p: p != "").alias("locations"),
        F.nullif(F.regexp_extract(cell(3), r"\((https?://[^)\s]+)\)|href=\"([^\"]+)\"", 1), F.lit("")).alias("apply_url"),
        cell(4).alias("date_posted"), cell(3).contains(CLOSED).alias("closed"))


def ingest_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Posting pages to title, links and readable text."""
    page = F.col(html)
    body = F.regexp_replace(page, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return pages.select(
        key, url, plain_text(F.regexp_extract(page, r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"),
        F.regexp_extract_all(page, F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), F.lit(1)).alias("links"),
        plain_text(body).alias("text"))


def flatten_vacancies(companies: DataFrame) -> DataFrame:
    """Companies with nested languages and vacancies to one row per vacancy.

    Expects alias and `languages` as array of (language, vacancies).
    """
    per_language = companies.select(
        F.col("id").alias("company_id"), "alias", "name", "ignore", F.explode("languages").alias("l"))
    return per_language.select("company_id", "alias", "name", "ignore", F.col("l.language").alias("language"),
                               F.inline("l.vacancies"))


