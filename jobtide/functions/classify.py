"""Experience level, job type and remote rules over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed
from .core import ColumnOrName, any_word, bind, col, collapse, contains_any, literal_array
from .text import strip_html


def years_required(text: ColumnOrName) -> Column:
    """Smallest number of years (0 to 30) a text asks for, null when it names none."""
    low = F.lower(col(text))
    found = F.flatten(F.array(*[
        F.regexp_extract_all(low, F.lit(p), F.lit(1)) for p in fixed.YEARS_PATTERNS]))
    years = F.filter(F.transform(found, lambda y: y.try_cast("int")), lambda y: y.between(0, 30))
    # Every pattern holds one of these words: a cheap test spares most texts.
    return F.when(low.contains("year") | low.contains("yr"), F.array_min(years))


def shortest(words: list[str]) -> list[str]:
    """Keywords that hold no other keyword of the list, sorted.

    Where a longer keyword occurs the shorter one inside it occurs as well, so
    these alone decide.
    """
    return sorted(w for w in words if not any(o != w and o in w for o in words))


def first_keyword(text: Column, classes: dict[str, list[str]]) -> Column:
    """First class (in order) with a keyword inside the text, as `class|keyword`.

    Plain substring search. Within a class the keyword reported is the first of
    the shortest ones in sorted order, so it is well defined.
    """
    def inside(name: str) -> Column:
        words = literal_array(shortest(classes[name]))
        first = F.filter(words, lambda w: text.contains(w))[0]
        return F.when(F.exists(words, lambda w: text.contains(w)), F.concat(F.lit(f"{name}|"), first))

    return F.coalesce(*[inside(name) for name in classes])


def level_from_years(years: Column, max_entry: int) -> Column:
    return (F.when(years <= max_entry, "entry").when(years <= 4, "mid").when(years <= 7, "senior")
            .when(years <= 10, "lead").when(years.isNotNull(), "staff"))


def entry_friendly(level: Column, years: Column, max_entry: int = 2, strict: bool = False) -> Column:
    """Whether a posting suits beginners; unknown postings do unless `strict`."""
    return (
        F.when(level.isin("intern", "entry"), True)
        .when(level.isin("senior", "lead", "staff", "principal", "executive"), False)
        .when(years.isNotNull(), years <= max_entry)
        .when(F.lit(strict), False)
        .otherwise(level == "unknown")
    )


def classification(
    title: ColumnOrName,
    description: ColumnOrName,
    location: ColumnOrName | None = None,
    job_type_hint: ColumnOrName | None = None,
    max_entry_years: int = 2,
    strict_entry: bool = False,
) -> Column:
    """Struct of experience_level, job_type, remote_type, entry_friendly,
    years_required, confidence and signals.

    The steps hand their results on as bound values. Plain intermediate columns
    would be copied into every filter on the outcome, again and again.
    """
    empty = F.lit("")
    nothing = F.lit(None).cast("string")
    low = lambda c: F.lower(F.coalesce(col(c), empty)) if c is not None else empty
    kind = lambda c: F.substring_index(c, "|", 1)
    word = lambda c: F.substring_index(c, "|", -1)
    by_title = lambda t: first_keyword(t, fixed.LEVEL_KEYWORDS)
    if job_type_hint is not None:
        hint = F.lower(col(job_type_hint))
        hinted = F.coalesce(*[F.when(contains_any(hint, fixed.JOB_TYPE_KEYWORDS[k]), F.lit(k))
                              for k in fixed.JOB_TYPE_HINT_ORDER])
        spoken = F.concat(F.lit("hint="), col(job_type_hint))
    else:
        hinted, spoken = nothing, nothing

    texts = F.struct(low(title).alias("head"),
                     F.concat_ws(" ", low(title), low(description)).alias("all"),
                     low(location).alias("place"))

    def find(x: Column) -> Column:
        return F.struct(
            x["all"].alias("all"), by_title(x["head"]).alias("lt"), years_required(x["all"]).alias("years"),
            hinted.alias("jh"),
            first_keyword(F.concat_ws(" ", x["all"], x["place"]), fixed.REMOTE_KEYWORDS).alias("rk"))

    def widen(x: Column) -> Column:
        return F.struct(
            x["lt"].alias("lt"), x["years"].alias("years"), x["jh"].alias("jh"), x["rk"].alias("rk"),
            F.when(x["lt"].isNull(), by_title(x["all"])).alias("ld"),
            F.when(x["jh"].isNull(), first_keyword(x["all"], fixed.JOB_TYPE_KEYWORDS)).alias("jk"))

    def settle(x: Column) -> Column:
        band = F.when(F.coalesce(x["lt"], x["ld"]).isNull(), level_from_years(x["years"], max_entry_years))
        years = x["years"].cast("string")
        signals = F.array_compact(F.array(
            F.when(x["years"] != 0, F.concat(F.lit("years_required="), years)),
            F.concat(F.lit("title_keyword="), word(x["lt"])),
            F.concat(F.lit("desc_keyword="), word(x["ld"])),
            F.concat(F.lit("years_based="), F.when(band == "staff", "staff+").otherwise(band),
                     F.lit("("), years, F.lit(")")),
            F.when(x["jh"].isNotNull(), spoken),
            F.concat(F.lit("keyword="), word(x["jk"])),
            F.concat(F.lit("remote_keyword="), word(x["rk"]))))
        return F.struct(
            F.coalesce(kind(x["lt"]), kind(x["ld"]), band, F.lit("unknown")).alias("level"),
            F.coalesce(x["jh"], kind(x["jk"]), F.lit("unknown")).alias("job"),
            F.coalesce(kind(x["rk"]), F.lit("unknown")).alias("remote"),
            x["years"].alias("years"), signals.alias("signals"))

    def result(x: Column) -> Column:
        in_title = F.size(F.filter(x["signals"], lambda s: s.contains("title")))
        confidence = F.least(
            F.when(col(description).isNotNull(), 0.5).otherwise(0.3)
            + F.least(F.size(x["signals"]) * 0.1, F.lit(0.4)) + F.least(in_title * 0.1, F.lit(0.2)),
            F.lit(1.0))
        return F.struct(
            x["level"].alias("experience_level"), x["job"].alias("job_type"), x["remote"].alias("remote_type"),
            entry_friendly(x["level"], x["years"], max_entry_years, strict_entry).alias("entry_friendly"),
            x["years"].alias("years_required"), F.round(confidence, 2).alias("confidence"),
            x["signals"].alias("signals"))

    return bind(bind(bind(bind(texts, find), widen), settle), result)


def classify(df: DataFrame, title: str = "title", description: str = "description",
             location: str | None = "location", job_type_hint: str | None = None,
             max_entry_years: int = 2, strict_entry: bool = False, out: str = "class") -> DataFrame:
    """Add the classification struct to a table."""
    return df.withColumn(out, classification(title, description, location, job_type_hint,
                                             max_entry_years, strict_entry))


def fill_from_class(df: DataFrame, cls: str = "class") -> DataFrame:
    """Fill only missing level, job type and remote type from the classification.

    An unknown level is written, an unknown job or remote type is not.
    """
    known = lambda field: F.nullif(F.col(f"{cls}.{field}"), F.lit("unknown"))
    missing = lambda c: F.nullif(F.col(c), F.lit(""))
    return (
        df.withColumn("experience_level", F.coalesce(missing("experience_level"), F.col(f"{cls}.experience_level")))
        .withColumn("job_type", F.coalesce(missing("job_type"), known("job_type")))
        .withColumn("remote_type", F.coalesce(missing("remote_type"), known("remote_type")))
    )


def entry_level_only(df: DataFrame, title: str = "title", description: str = "description", **options) -> DataFrame:
    """Keep the postings that suit beginners, with the input columns unchanged."""
    return df.filter(classification(title, description, **options)["entry_friendly"])


def least_years(text: Column) -> Column:
    """Smallest number of years in any `n years` or `n-m years` text, 0 when there is none."""
    patterns = [r"(\d+)-\d*\+?\s*years?", r"(\d+)\s*\+\s*years?", r"at least (\d+)\s*years?",
                r"(\d+)\s*years?"]
    found = F.flatten(F.array(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in patterns]))
    numbers = F.filter(F.transform(found, lambda y: y.try_cast("long")), lambda y: y.isNotNull())
    return F.when(text.contains("year"), F.coalesce(F.array_min(numbers), F.lit(0))).otherwise(0)


def is_entry_level_strict(title: ColumnOrName, description: ColumnOrName,
                          minimum: ColumnOrName, preferred: ColumnOrName) -> Column:
    """Word-bounded rule: intern title, then senior title, then years of experience.

    Postings that name no years are accepted.
    """
    clean = lambda c: F.lower(collapse(strip_html(c)))
    head = clean(title)
    body = F.trim(F.concat_ws(" ", clean(minimum), clean(preferred), clean(description)))
    return (
        F.when(head.rlike(r"\bintern\b"), True)
        .when(head.rlike(r"\b(?:" + any_word(fixed.STRICT_NEGATIVE) + r")\b"), False)
        .when(body.rlike(r"\b0-\d*\+?\s*years?"), True)
        .when(least_years(body) > 1, False)
        .otherwise(True)
    )


def level_from_flags(title: ColumnOrName, is_intern: ColumnOrName, university: ColumnOrName,
                     is_manager: ColumnOrName) -> Column:
    """Level from a board's own flags and its title words, null when neither tells."""
    low = F.lower(col(title))
    flag = lambda c: F.coalesce(col(c).cast("boolean"), F.lit(False))
    return (
        F.when(low.contains("intern") | flag(is_intern), "intern")
        .when(contains_any(low, ["entry", "new grad"]) | flag(university), "entry")
        .when(contains_any(low, ["junior", "jr"]), "entry")
        .when(contains_any(low, ["senior", "sr"]), "senior")
        .when(contains_any(low, ["principal", "staff"]), "lead")
        .when(contains_any(low, ["director", "vp"]), "executive")
        .when(flag(is_manager), "senior")
    )


def relevant_title(c: ColumnOrName) -> Column:
    """Whether a title names machine learning work, on word bounds."""
    return col(c).rlike(r"(?i)\b(?:" + any_word(fixed.RELEVANT_PHRASES) + r")\b")
