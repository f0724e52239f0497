"""Date rules. Every rule that depends on the clock takes `as_of`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import ColumnOrName, col, group

DATE_FORMATS = ["yyyy-MM-dd", "M/d/yyyy", "d/M/yyyy", "MMMM d, yyyy", "d MMMM yyyy",
                "d MMM yyyy", "d-MMM-yyyy"]
ISO_FORMATS = ["yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]", "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS][XXX]"]
GAP = r"(?:[ +]{1,3})?"


def relative_date(c: ColumnOrName, as_of: ColumnOrName) -> Column:
    """Date meant by an age text such as `3 days`, `+30d` or `yesterday`.

    Hours are tried first, then days, months, years. Text without an age counts
    as today, an age of ten digits or more as unknown.
    """
    text, now = col(c), col(as_of)

    def count(pattern: str) -> Column:
        return group(text, pattern).try_cast("int")

    hours, days = count(rf"(\d+){GAP}(?:hour|hr|heure)"), count(rf"(\d+){GAP}(?:day|d|jour)")
    months, years = count(rf"(\d+){GAP}month"), count(rf"(\d+){GAP}year")
    return (
        F.when(text.isNull() | text.rlike(rf"\d{{10,}}{GAP}(?:hour|hr|heure|day|d|jour|month|year)"), F.lit(None).cast("date"))
        .when(hours.isNotNull(), F.to_date(F.timestamp_seconds(F.unix_timestamp(now) - hours * 3600)))
        .when(days.isNotNull(), F.date_sub(F.to_date(now), days))
        .when(months.isNotNull(), F.to_date(F.add_months(now, -months)))
        .when(years.isNotNull(), F.to_date(F.add_months(now, -12 * years)))
        .when(text.rlike("[yY]esterday"), F.date_sub(F.to_date(now), 1))
        .otherwise(F.to_date(now))
    )


def parse_date(c: ColumnOrName) -> Column:
    """Timestamp of date text in ISO, US, European or spelled-out form, else null."""
    text = F.trim(F.replace(col(c), F.lit("Deadline:"), F.lit("")))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in ISO_FORMATS + DATE_FORMATS])


def local_time(epoch: ColumnOrName, zone: str = "America/New_York") -> Column:
    """Epoch seconds as wall-clock text of a zone."""
    return F.date_format(F.from_utc_timestamp(F.timestamp_seconds(col(epoch)), zone),
                         "yyyy-MM-dd HH:mm:ss")


def days_since(posted: ColumnOrName, as_of: ColumnOrName) -> Column:
    """Whole days passed, rounded down."""
    seconds = F.unix_timestamp(col(as_of)) - F.unix_timestamp(col(posted))
    return F.floor(seconds / 86400).cast("int")


def recently_posted(posted: ColumnOrName, as_of: ColumnOrName, days: int = 7) -> Column:
    return F.coalesce(days_since(posted, as_of) <= days, F.lit(False))


def label_date(label: ColumnOrName, created_ms: ColumnOrName, as_of: ColumnOrName) -> Column:
    """Posting date of a label such as `3 Days Ago`, else of epoch milliseconds."""
    text = F.lower(col(label))
    created = F.to_date(F.timestamp_millis(F.nullif(col(created_ms), F.lit(0))))
    age = group(text, r"(\d+)\s*day").try_cast("int")
    return (
        F.when(F.coalesce(text, F.lit("")) == "", created)
        .when(text.rlike("today|just now|few hours"), F.to_date(col(as_of)))
        .when(text.contains("ago"), F.date_sub(F.to_date(col(as_of)), age))
        .otherwise(created)
    )


def relative_label(c: ColumnOrName, as_of: ColumnOrName) -> Column:
    """Elapsed time in words."""
    s = F.unix_timestamp(col(as_of)) - F.unix_timestamp(col(c))
    days = F.floor(s / 86400)

    def unit(n: Column, one: str, word: str) -> Column:
        return F.when(n == 1, F.lit(f"{one} {word} ago")).otherwise(
            F.concat(n.cast("string"), F.lit(f" {word}s ago")))

    months = F.floor(days / F.lit(30.5))
    return (
        F.when(s.isNull(), "Unknown")
        .when(s < 1, "now")
        .when(s < 60, unit(s, "a", "second"))
        .when(s < 3600, unit(F.floor(s / 60), "a", "minute"))
        .when(s < 86400, unit(F.floor(s / 3600), "an", "hour"))
        .when(days < 31, unit(days, "a", "day"))
        .when(days < 365, unit(F.greatest(months, F.lit(1)), "a", "month"))
        .otherwise(unit(F.floor(days / 365), "a", "year"))
    )


def run_speed(jobs: ColumnOrName, start: ColumnOrName, end: ColumnOrName) -> Column:
    """Jobs per minute of a run, one decimal; zero when it cannot be told."""
    minutes = (F.unix_micros(col(end)) - F.unix_micros(col(start))) / F.lit(60_000_000.0)
    return F.when((col(jobs) >= 0) & (minutes > 0), F.bround(col(jobs) / minutes, 1)).otherwise(0.0)


def duration_label(seconds: Column) -> Column:
    """Seconds as hours and minutes, or minutes and seconds, zero parts left out."""
    hours, minutes, rest = (F.floor(seconds / 3600), F.floor((seconds % 3600) / 60), seconds % 60)

    def two(a: Column, first: str, b: Column, second: str) -> Column:
        tail = F.when(b > 0, F.concat(F.lit(" "), b.cast("string"), F.lit(second))).otherwise("")
        return F.concat(a.cast("string"), F.lit(first), tail)

    return (F.when(hours > 0, two(hours, "h", minutes, "m"))
            .when(minutes > 0, two(minutes, "m", rest, "s"))
            .otherwise(F.concat(F.greatest(rest, F.lit(0)).cast("string"), F.lit("s"))))


def run_eta(total: ColumnOrName, done: ColumnOrName, elapsed: ColumnOrName) -> Column:
    """Time left of a run in words, judged by the pace so far."""
    left = F.floor((col(total) - col(done)) * (col(elapsed) / col(done))).cast("long")
    return (
        F.when((col(total) <= 0) | (col(done) < 0) | (col(elapsed) < 0), "Unknown")
        .when(col(done) >= col(total), "Done")
        .when((col(done) == 0) | (col(elapsed) == 0), "Calculating...")
        .otherwise(duration_label(left))
    )
