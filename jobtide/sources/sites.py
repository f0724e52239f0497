"""Landed job-site JSON to the multi-site table, the master list and board rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.core import group, lookup
from ..functions.dates import label_date, parse_date, relative_date
from ..functions.normalize import (
    city_state, industry_label, job_type_code, job_type_tags, location_type, remote_flag,
    site_location, tracker_job_type, work_from_home_type,
)
from ..functions.salary import (
    PAY_SCHEMA, indian_salary, nested_compensation, percentile_compensation,
)
from ..functions.text import emails, joined
from ..operators.dedup import first_per_site

TYPES = {"date_posted": "date", "min_amount": "double", "max_amount": "double", "is_remote": "boolean",
         "company_rating": "double", "company_reviews_count": "long", "vacancy_count": "long"}


def site_frame(df: DataFrame, *extra: str, **values: Column) -> DataFrame:
    """The fixed column list, null where a site does not give a value."""
    return df.select(*[
        values.get(c, F.lit(None)).cast(TYPES.get(c, "string")).alias(c) for c in fixed.SITE_COLUMNS], *extra)


def merge_sites(*frames: DataFrame, order: bool = True) -> DataFrame:
    """Union of site tables in the fixed column order, by site, newest first."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    for c in fixed.SITE_COLUMNS:
        if c not in merged.columns:
            merged = merged.withColumn(c, F.lit(None).cast(TYPES.get(c, "string")))
    merged = merged.select(*fixed.SITE_COLUMNS)
    return merged.orderBy("site", F.col("date_posted").desc(), "id") if order else merged


INDEED = f"""key string, title string, description struct<html:string>, datePublished long,
attributes array<struct<label:string>>, location struct<city:string,admin1Code:string,countryCode:string,
formatted:struct<long:string>>, compensation struct<{PAY_SCHEMA}>,
recruit struct<viewJobUrl:string>, employer struct<name:string,relativeCompanyPageUrl:string,
dossier:struct<links:struct<corporateWebsite:string>,images:struct<squareLogoUrl:string>,
employerDetails:struct<addresses:array<string>,industry:string,employeesLocalizedLabel:string,
revenueLocalizedLabel:string,briefDescription:string>>>"""


def _indeed(df: DataFrame, base: str) -> DataFrame:
    j = F.col("j")
    text = j["description"]["html"]
    codes = F.array_compact(F.transform(j["attributes"], lambda a: job_type_code(a["label"])))
    labels = F.array_join(F.transform(j["attributes"], lambda a: a["label"]), "\n")
    employer, details = j["employer"], j["employer"]["dossier"]["employerDetails"]
    df = df.withColumn("_pay", nested_compensation(j["compensation"]))
    return site_frame(
        df, "_seq", id=F.concat(F.lit("in-"), j["key"]), site=F.lit("indeed"),
        job_url=F.concat(F.lit(f"{base}/viewjob?jk="), j["key"]), job_url_direct=j["recruit"]["viewJobUrl"],
        title=j["title"], company=employer["name"],
        location=site_location(j["location"]["city"], j["location"]["admin1Code"], j["location"]["countryCode"]),
        date_posted=F.to_date(F.timestamp_millis(j["datePublished"])), job_type=joined(codes),
        salary_source=F.when(F.col("_pay.min_amount") != 0, "direct_data"), interval=F.col("_pay.interval"),
        min_amount=F.col("_pay.min_amount"), max_amount=F.col("_pay.max_amount"), currency=F.col("_pay.currency"),
        is_remote=remote_flag(labels, text, j["location"]["formatted"]["long"]), emails=joined(emails(text)),
        description=text, company_industry=industry_label(details["industry"]),
        company_url=F.concat(F.lit(base), employer["relativeCompanyPageUrl"]),
        company_logo=employer["dossier"]["images"]["squareLogoUrl"],
        company_url_direct=employer["dossier"]["links"]["corporateWebsite"],
        company_addresses=F.get(details["addresses"], F.lit(0)),
        company_num_employees=details["employeesLocalizedLabel"], company_revenue=details["revenueLocalizedLabel"],
        company_description=details["briefDescription"])


ZIPRECRUITER = """listing_key string, name string, job_description string, buyer_type string,
hiring_company struct<name:string>, job_country string, job_city string, job_state string,
employment_type string, posted_time string, compensation_interval string, compensation_min double,
compensation_max double, compensation_currency string"""


def _ziprecruiter(df: DataFrame, base: str) -> DataFrame:
    j = F.col("j")
    text = F.trim(F.coalesce(j["job_description"], F.lit("")))
    code = job_type_code(F.replace(j["employment_type"], F.lit("_"), F.lit("")))
    country = F.when(j["job_country"] == "US", "usa").otherwise("canada")
    low = F.floor(j["compensation_min"])
    return site_frame(
        df, "_seq", id=F.concat(F.lit("zr-"), j["listing_key"]), site=F.lit("zip_recruiter"),
        job_url=F.concat(F.lit(f"{base}/jobs//j?lvk="), j["listing_key"]), title=j["name"],
        company=j["hiring_company"]["name"], location=site_location(j["job_city"], j["job_state"], country),
        date_posted=F.to_date(parse_date(F.regexp_replace(j["posted_time"], "Z$", ""))), job_type=code,
        salary_source=F.when(low != 0, "direct_data"),
        interval=F.when(j["compensation_interval"] == "annual", "yearly").otherwise(j["compensation_interval"]),
        min_amount=low, max_amount=F.floor(j["compensation_max"]), currency=j["compensation_currency"],
        listing_type=j["buyer_type"], emails=joined(emails(text)), description=text)


GLASSDOOR = """jobview struct<job:struct<listingId:string,jobTitleText:string>,
header:struct<employerNameFromSearch:string,employer:struct<id:string>,locationName:string,locationType:string,
ageInDays:int,payPeriod:string,payCurrency:string,payPeriodAdjustedPay:struct<p10:double,p90:double>,
adOrderSponsorshipLevel:string>,overview:struct<squareLogoUrl:string>>"""


def _glassdoor(df: DataFrame, base: str, as_of: Column) -> DataFrame:
    v = F.col("j.jobview")
    h = v["header"]
    pay = percentile_compensation(h["payPeriod"], h["payPeriodAdjustedPay"]["p10"],
                                  h["payPeriodAdjustedPay"]["p90"], h["payCurrency"])
    df = df.withColumn("_pay", pay)
    remote = F.coalesce(h["locationType"] == "S", F.lit(False))
    place = F.when(~remote, city_state(h["locationName"]))
    return site_frame(
        df, "_seq", id=F.concat(F.lit("gd-"), v["job"]["listingId"]), site=F.lit("glassdoor"),
        job_url=F.concat(F.lit(f"{base}job-listing/j?jl="), v["job"]["listingId"]), title=v["job"]["jobTitleText"],
        company=h["employerNameFromSearch"],
        location=F.when(place.isNotNull(), F.concat_ws(", ", F.nullif(place["city"], F.lit("")), F.nullif(place["state"], F.lit("")))),
        date_posted=F.date_sub(F.to_date(as_of), h["ageInDays"]),
        salary_source=F.when(F.col("_pay.min_amount") != 0, "direct_data"), interval=F.col("_pay.interval"),
        min_amount=F.col("_pay.min_amount"), max_amount=F.col("_pay.max_amount"), currency=F.col("_pay.currency"),
        is_remote=remote, listing_type=F.lower(h["adOrderSponsorshipLevel"]),
        company_url=F.concat(F.lit(f"{base}Overview/W-EI_IE"), h["employer"]["id"], F.lit(".htm")),
        company_logo=v["overview"]["squareLogoUrl"])


NAUKRI = """jobId string, title string, companyName string, staticUrl string, jdURL string,
placeholders array<struct<type:string,label:string>>, footerPlaceholderLabel string, createdDate long,
jobDescription string, logoPathV3 string, logoPath string, tagsAndSkills string, experienceText string,
ambitionBoxData struct<AggregateRating:string,ReviewsCount:long>, vacancy long"""


def _naukri(df: DataFrame, base: str, as_of: Column) -> DataFrame:
    j = F.col("j")
    label = lambda kind: F.try_element_at(
        F.filter(j["placeholders"], lambda p: p["type"] == kind), F.lit(1))["label"]
    df = df.withColumn("_place", label("location")).withColumn("_pay", indian_salary(label("salary")))
    parts = F.split("_place", ", ")
    text = F.coalesce(j["jobDescription"], F.lit(""))
    title = F.coalesce(j["title"], F.lit("N/A"))
    where = site_location(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.lit("india"))
    return site_frame(
        df, "_seq", id=F.concat(F.lit("nk-"), j["jobId"]), site=F.lit("naukri"),
        job_url=F.concat(F.lit(base), F.coalesce(j["jdURL"], F.concat(F.lit("/job/"), j["jobId"]))),
        title=title, company=F.coalesce(j["companyName"], F.lit("N/A")), location=where,
        date_posted=label_date(j["footerPlaceholderLabel"], j["createdDate"], as_of),
        salary_source=F.when(F.col("_pay.min_amount") != 0, "direct_data"),
        min_amount=F.col("_pay.min_amount"), max_amount=F.col("_pay.max_amount"), currency=F.col("_pay.currency"),
        is_remote=remote_flag(title, text, where), emails=joined(emails(text)), description=j["jobDescription"],
        company_url=F.concat(F.lit(f"{base}/"), F.nullif(j["staticUrl"], F.lit(""))),
        company_logo=F.coalesce(F.nullif(j["logoPathV3"], F.lit("")), j["logoPath"]),
        skills=F.replace(F.nullif(j["tagsAndSkills"], F.lit("")), F.lit(","), F.lit(", ")),
        experience_range=j["experienceText"], company_rating=j["ambitionBoxData"]["AggregateRating"].try_cast("double"),
        company_reviews_count=j["ambitionBoxData"]["ReviewsCount"], vacancy_count=j["vacancy"],
        work_from_home_type=work_from_home_type("_place", title, text))


GOOGLE = "array<string>"


def _google(df: DataFrame, as_of: Column) -> DataFrame:
    """Postings arrive as a list whose places have fixed meanings."""
    at = lambda i: F.get(F.col("j"), F.lit(i))
    df = df.withColumn("_parts", F.transform(F.split(at(2), ","), lambda p: F.trim(p)))
    many = at(2).contains(",")
    part = lambda i: F.get("_parts", F.lit(i))
    text = at(19)
    return site_frame(
        df, "_seq", id=F.concat(F.lit("go-"), at(28)), site=F.lit("google"),
        job_url=F.get_json_object(at(3), "$[0][0]"), title=at(0), company=at(1),
        location=site_location(F.when(many, part(0)).otherwise(at(2)), F.when(many, part(1)), F.when(many, part(2))),
        date_posted=F.date_sub(F.to_date(as_of), group(at(12), r"(\d+)").try_cast("int")),
        job_type=joined(job_type_tags(text)),
        is_remote=F.lower(text).contains("remote") | F.lower(text).contains("wfh"),
        emails=joined(emails(text)), description=text)


# Site addresses.
SITE_BASES = {"indeed": "https://www.indeed.com", "zip_recruiter": "https://www.ziprecruiter.com",
              "glassdoor": "https://www.glassdoor.com/", "naukri": "https://www.naukri.com"}


def ingest_board(raw: DataFrame, site: str, as_of: datetime, base: str | None = None,
                 order: str = "seq") -> DataFrame:
    """One landed posting per row (`value`) to the multi-site table, first per URL."""
    base = base or SITE_BASES.get(site, "")
    schemas = {"indeed": INDEED, "zip_recruiter": ZIPRECRUITER, "glassdoor": GLASSDOOR, "naukri": NAUKRI,
               "google": GOOGLE}
    if site not in schemas:
        raise ValueError(f"unknown site {site!r}")
    df = raw.select(F.from_json("value", schemas[site]).alias("j"), F.col(order).alias("_seq"))
    now = F.lit(as_of)
    rows = {"indeed": lambda: _indeed(df, base), "zip_recruiter": lambda: _ziprecruiter(df, base),
            "glassdoor": lambda: _glassdoor(df, base, now), "naukri": lambda: _naukri(df, base, now),
            "google": lambda: _google(df, now)}[site]()
    return first_per_site(rows, "site", "job_url", "_seq").drop("_seq")


TAXONOMY = """displayTitle string, snippet string, company string, formattedLocation string,
taxonomyAttributes array<struct<label:string,attributes:array<struct<label:string>>>>, remoteLocation boolean,
extractedSalary struct<min:double,max:double,type:string>, formattedRelativeTime string, jobkey string"""

# Remote tag -> remoteness.
TAG_REMOTENESS = {"remote": "FULLY_REMOTE", "hybrid work": "TEMPORARILY_REMOTE"}


def ingest_taxonomy_board(raw: DataFrame, as_of: datetime, provider: str, query: str, locale: str,
                          link: str = "https://www.indeed.com/viewjob?jk=") -> DataFrame:
    """Board JSON with tag groups to master-list rows."""
    j = F.from_json("value", TAXONOMY)
    df = raw.select(j.alias("j"))
    j = F.col("j")
    groups = F.filter(F.coalesce(j["taxonomyAttributes"], F.array()), lambda g: F.size(g["attributes"]) > 0)
    head = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1000)))
    df = df.withColumn("tags", F.transform(groups, lambda g: F.concat(
        head(F.replace(g["label"], F.lit("-"), F.lit(" "))), F.lit(": "), F.array_join(F.transform(g["attributes"], lambda a: a["label"]), ", "))))
    spoken = F.try_element_at(F.filter("tags", lambda t: F.lower(t).contains("remote")), F.lit(1))
    tagged = F.coalesce(lookup(TAG_REMOTENESS, F.lower(F.trim(F.substring_index(spoken, ":", -1)))), F.lit("UNKNOWN"))
    flagged = F.when(F.coalesce(j["remoteLocation"], F.lit(False)), "FULLY_REMOTE").otherwise("UNKNOWN")
    pay = j["extractedSalary"]
    number = lambda c: F.regexp_replace(c.cast("string"), r"\.0$", "")
    wage = F.when((pay["min"] != 0) & (pay["max"] != 0), F.concat(
        F.lit("$"), number(pay["min"]), F.lit(" - $"), number(pay["max"]), F.lit(" "),
        F.coalesce(pay["type"], F.lit("")))).otherwise("")
    return df.select(
        F.lit("NEW").alias("status"), j["displayTitle"].alias("title"), j["company"].alias("company"),
        j["formattedLocation"].alias("location"),
        relative_date(j["formattedRelativeTime"], F.lit(as_of)).alias("date"), j["snippet"].alias("blurb"),
        F.array_join("tags", "\n").alias("tags"), F.concat(F.lit(link), j["jobkey"]).alias("link"),
        j["jobkey"].alias("id"), F.lit(provider).alias("provider"), F.lit(query).alias("query"),
        F.lit(locale).alias("locale"), F.coalesce(wage, F.lit("")).alias("wage"),
        F.when(spoken.isNotNull(), tagged).otherwise(flagged).alias("remoteness"))


COMPANY_SITE = "id string, title string, job_path string, location string, locations array<string>, posted_date string"


def ingest_company_site(raw: DataFrame, as_of: datetime, company: str, base: str, place: str) -> DataFrame:
    """Company-site JSON to entry rows, newest first. `place` is the searched location."""
    df = raw.select(F.from_json("value", COMPANY_SITE).alias("j")).filter("coalesce(j.id, '') <> ''")
    j = F.col("j")
    first = F.get_json_object(F.get(j["locations"], F.lit(0)), "$.normalizedLocation")
    spot = F.coalesce(F.when(F.size(j["locations"]) > 0, F.coalesce(first, F.lit(place))), j["location"], F.lit(place))
    spaced = F.regexp_replace(j["posted_date"], r"\s+", " ")
    posted = F.try_to_timestamp(F.trim(spaced), F.lit("MMMM d, yyyy"))
    path = F.nullif(j["job_path"], F.lit(""))
    return df.select(
        F.lit(company).alias("company"), F.coalesce(j["title"], F.lit("Unknown Title")).alias("job_title"),
        F.concat(F.lit(base), F.coalesce(path, F.concat(F.lit("/en/jobs/"), j["id"]))).alias("url"),
        F.when(F.lower(spot).contains("remote"), F.lit(f"Remote - {place}")).otherwise(spot).alias("location"),
        F.coalesce(F.date_format(posted, "yyyy-MM-dd"), F.lit("N/A")).alias("posted_time"),
        F.coalesce(posted, F.lit(as_of)).alias("posted_datetime"),
    ).orderBy(F.col("posted_datetime").desc(), "url")


SEARCH_RESPONSE = """included array<struct<`$type`:string,repostedJob:boolean,entityUrn:string,title:string>>"""


def ingest_search_response(raw: DataFrame, item_type: str = "com.linkedin.voyager.dash.jobs.JobPosting",
                           link: str = "https://www.linkedin.com/jobs/view/") -> DataFrame:
    """Postings of a search response: one item type, no reposts, id from the URN."""
    items = raw.select(F.explode(F.from_json("value", SEARCH_RESPONSE)["included"]).alias("i"))
    i = F.col("i")
    kept = items.filter((i["$type"] == item_type) & ~F.coalesce(i["repostedJob"], F.lit(False)))
    key = F.get(F.split(i["entityUrn"], ":"), F.lit(3))
    return kept.select(key.alias("job_id"), F.coalesce(i["title"], F.lit("")).alias("job_title"),
                       F.concat(F.lit(link), key, F.lit("/")).alias("url"))


def detail_line(c: str) -> Column:
    """Location, repost age and applicants of a dotted detail line."""
    parts = F.transform(F.split(F.col(c), "·"), lambda p: F.trim(p))
    unknown = F.lit("Unknown")
    several = F.size(parts) >= 2
    return F.struct(
        F.when(several, parts[0]).otherwise(F.col(c)).alias("location"),
        F.when(several, F.get(parts, F.lit(1))).otherwise(unknown).alias("repost_info"),
        F.when(F.size(parts) >= 3, F.get(parts, F.lit(2))).otherwise(unknown).alias("apply_clicks"))


def coerce_postings(df: DataFrame) -> DataFrame:
    """Tolerant typing of a scraped frame: blanks to null, numbers, codes, location type."""
    clean = df.select(*[
        F.when(F.trim(F.col(c)) != "", F.col(c)).alias(c) if t == "string" else F.col(c)
        for c, t in df.dtypes])
    number = lambda c: F.col(c).try_cast("double")
    return (
        clean.withColumn("min_amount", number("min_amount")).withColumn("max_amount", number("max_amount"))
        .withColumn("company_rating", number("company_rating"))
        .withColumn("site", F.replace(F.lower(F.trim("site")), F.lit(" "), F.lit("_")))
        .withColumn("job_type", tracker_job_type("job_type"))
        .withColumn("location_type", location_type(F.col("is_remote").try_cast("boolean"), "location"))
    )
