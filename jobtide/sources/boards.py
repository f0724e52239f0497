"""Landed board JSON to the canonical job table.

Each function takes one JSON text per row (`value`) and the attributes of the
source it came from, and gives canonical rows. Rows without an id or a title drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import level_from_flags
from ..functions.core import lookup, strip

CANONICAL = ["source_id", "external_id", "title", "company", "location", "description", "url",
             "job_type", "experience_level", "remote_type"]


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _canonical(df: DataFrame, **values: Column) -> DataFrame:
    rows = df.select(*[
        values.get(c, F.lit(None)).cast("long" if c == "source_id" else "string").alias(c)
        for c in CANONICAL])
    return rows.filter("coalesce(external_id, '') <> '' and coalesce(title, '') <> ''")


GREENHOUSE = """jobs array<struct<id:string,title:string,absolute_url:string,content:string,
location:struct<name:string>,metadata:array<struct<name:string,value:string>>>>"""


def ingest_greenhouse(raw: DataFrame, board: str = "board") -> DataFrame:
    """One response per row, with a `jobs` list. Needs source_id, company and a board column."""
    jobs = raw.select("source_id", "company", F.col(board).alias("_board"), F.explode(
        F.from_json("value", GREENHOUSE)["jobs"]).alias("j"))
    j = F.col("j")

    def meta(*names: str) -> Column:
        hits = F.filter(j["metadata"], lambda m: F.lower(F.coalesce(m["name"], F.lit(""))).isin(*names))
        return F.try_element_at(hits, F.lit(-1))["value"]

    link = F.concat(F.lit("https://boards.greenhouse.io/"), "_board", F.lit("/jobs/"), j["id"])
    return _canonical(
        jobs, source_id=F.col("source_id"), external_id=j["id"], title=strip(j["title"]),
        company=F.col("company"), location=j["location"]["name"],
        description=F.coalesce(j["content"], F.lit("")), url=F.coalesce(j["absolute_url"], link),
        job_type=meta("employment type", "job type", "type"),
        experience_level=meta("experience level", "seniority", "level"))


LEVER = """id string, text string, hostedUrl string, applyUrl string, descriptionPlain string,
categories struct<location:string,team:string,commitment:string>,
lists array<struct<text:string,content:string>>"""


def ingest_lever(raw: DataFrame) -> DataFrame:
    """One posting per row. Needs source_id and company columns."""
    df = raw.select("source_id", "company", F.from_json("value", LEVER).alias("j"))
    j = F.col("j")
    sections = F.transform(
        F.filter(F.coalesce(j["lists"], F.array()), lambda s: (s["text"] != "") & (s["content"] != "")),
        lambda s: F.concat(F.lit("\n"), s["text"], F.lit(":\n"), s["content"]))
    parts = F.concat(F.array_compact(F.array(_filled(j["descriptionPlain"]))), sections)
    commitment = F.lower(j["categories"]["commitment"])
    kind = (F.when(commitment.contains("full"), "full-time").when(commitment.contains("part"), "part-time")
            .when(commitment.contains("contract"), "contract").when(commitment.contains("intern"), "internship"))
    return _canonical(
        df, source_id=F.col("source_id"), external_id=j["id"], title=strip(j["text"]),
        company=F.col("company"), location=_filled(j["categories"]["location"]),
        description=F.when(F.size(parts) > 0, F.array_join(parts, "\n")),
        url=F.coalesce(_filled(j["hostedUrl"]), j["applyUrl"], F.lit("")), job_type=kind)


ASHBY = """id string, title string, jobUrl string, applyUrl string, location string, locationName string,
address struct<addressLocality:string,addressRegion:string,addressCountry:string>, locations array<string>,
isRemote boolean, isOnsite boolean, descriptionPlain string, descriptionHtml string, employmentType string,
publishedAt string"""

# Employment type -> job type.
ASHBY_TYPES = {
    "FullTime": "full-time", "Full-Time": "full-time", "Full Time": "full-time",
    "PartTime": "part-time", "Part-Time": "part-time", "Part Time": "part-time",
    "Contract": "contract", "Contractor": "contract", "Intern": "internship",
    "Internship": "internship", "Temporary": "temporary", "Temp": "temporary",
}


def ingest_ashby(raw: DataFrame, slug: str = "slug") -> DataFrame:
    """One posting per row. Needs source_id, company and a slug column."""
    df = raw.select("source_id", "company", F.col(slug).alias("_slug"), F.from_json("value", ASHBY).alias("j"))
    j = F.col("j")
    address = F.concat_ws(", ", *[_filled(j["address"][f]) for f in
                                  ("addressLocality", "addressRegion", "addressCountry")])
    first = F.get(j["locations"], F.lit(0))
    # A location list holds texts or objects; objects arrive as JSON text.
    listed = F.when(first.startswith("{"), F.coalesce(
        _filled(F.get_json_object(first, "$.name")), F.get_json_object(first, "$.location"))).otherwise(first)
    df = df.withColumn("_place", F.coalesce(
        _filled(j["location"]), F.when(j["address"].isNotNull(), address), _filled(j["locationName"]), listed))
    remote = F.coalesce(j["isRemote"], F.lower("_place").contains("remote"), F.lit(False))
    kind = _filled(j["employmentType"])
    link = F.concat(F.lit("https://jobs.ashbyhq.com/"), "_slug", F.lit("/"), j["id"])
    return _canonical(
        df, source_id=F.col("source_id"), external_id=j["id"], title=strip(j["title"]),
        company=F.col("company"), location=F.col("_place"),
        description=F.coalesce(_filled(j["descriptionPlain"]), j["descriptionHtml"], F.lit("")),
        url=F.coalesce(_filled(j["jobUrl"]), _filled(j["applyUrl"]), link),
        job_type=F.coalesce(lookup(ASHBY_TYPES, kind), F.replace(F.lower(kind), F.lit(" "), F.lit("-"))),
        remote_type=F.when(remote, "remote").when(F.coalesce(j["isOnsite"], F.lit(False)), "onsite"))


AMAZON = """id string, id_icims string, title string, location string, normalized_location string, city string,
country_code string, job_path string, description string, description_short string,
basic_qualifications string, preferred_qualifications string, job_schedule_type string,
locations array<string>, is_intern boolean, university_job boolean, is_manager boolean"""


def ingest_amazon(raw: DataFrame, base: str = "https://www.amazon.jobs", company: str = "Amazon") -> DataFrame:
    """One posting per row. Needs a source_id column."""
    df = raw.select("source_id", F.from_json("value", AMAZON).alias("j"))
    j = F.col("j")
    text = lambda f: F.coalesce(j[f], F.lit(""))
    key = F.coalesce(_filled(j["id_icims"]), j["id"], F.lit(""))
    title = strip(text("title"))
    place = F.coalesce(_filled(j["normalized_location"]), _filled(j["location"]),
                       F.concat(_filled(j["city"]), F.lit(", "), text("country_code")), F.lit(""))
    lead = F.concat_ws("\n\n", _filled(j["description_short"]), _filled(j["description"]))
    section = lambda head, f: F.when(
        text(f) != "", F.concat(F.lit(f"\n\n## {head}\n"), j[f])).otherwise("")
    kinds = F.filter(
        F.transform(F.coalesce(j["locations"], F.array().cast("array<string>")),
                    lambda s: F.lower(F.get_json_object(s, "$.type"))),
        lambda t: t.isin("remote", "hybrid", "onsite"))
    return _canonical(
        df, source_id=F.col("source_id"), external_id=key, title=title, company=F.lit(company),
        location=place,
        description=F.concat(lead, section("Basic Qualifications", "basic_qualifications"),
                             section("Preferred Qualifications", "preferred_qualifications")),
        url=F.concat(F.lit(base), F.coalesce(j["job_path"], F.concat(F.lit("/en/jobs/"), key))),
        job_type=_filled(j["job_schedule_type"]),
        experience_level=level_from_flags(title, j["is_intern"], j["university_job"], j["is_manager"]),
        remote_type=F.get(kinds, F.lit(0)))
