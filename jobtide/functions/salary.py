"""Salary rules: annual amounts, salary text and salary display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .core import ColumnOrName, bind, col, contains_any, group, lookup, one_of
from .normalize import number_text

PER_YEAR = {name: times for name, _, times in fixed.PERIOD_MARKS} | {"unknown": 1}


def pay_period(c: ColumnOrName) -> Column:
    """Pay period named by a text, by substring and in fixed order."""
    text = F.lower(F.coalesce(col(c), F.lit("")))
    (first, marks, _), *others = fixed.PERIOD_MARKS
    period = F.when(contains_any(text, marks), first)
    for name, marks, _ in others:
        period = period.when(contains_any(text, marks), name)
    return period.otherwise("unknown")


def known_currency(c: ColumnOrName) -> Column:
    code = F.upper(F.coalesce(col(c), F.lit("")))
    return F.when(one_of(code, fixed.CURRENCY_RATES), code).otherwise("USD")


def annual_usd(amount: ColumnOrName, period: ColumnOrName, currency: ColumnOrName) -> Column:
    """Yearly dollars to the nearest thousand, half to even; null unless positive, and beyond an int."""
    dollars = col(amount).cast("double") * lookup(fixed.CURRENCY_RATES, col(currency))
    yearly = dollars * lookup(PER_YEAR, col(period))
    return F.when(col(amount) > 0, (F.bround(yearly / 1000, 0) * 1000).try_cast("int"))


def annualize_salary(low: ColumnOrName, high: ColumnOrName, period: ColumnOrName,
                     currency: ColumnOrName) -> Column:
    """Struct of min_yearly, max_yearly, original_period, original_currency, is_estimated."""
    def ordered(s: Column) -> Column:
        a = annual_usd(s["low"], s["period"], s["currency"])
        b = annual_usd(s["high"], s["period"], s["currency"])

        def pair(p: Column) -> Column:
            swap = (p["a"] > p["b"]) & (p["a"] != 0) & (p["b"] != 0)
            return F.struct(
                F.when(swap, p["b"]).otherwise(p["a"]).alias("min_yearly"),
                F.when(swap, p["a"]).otherwise(p["b"]).alias("max_yearly"),
                s["period"].alias("original_period"),
                s["currency"].alias("original_currency"),
                (s["period"] != "yearly").alias("is_estimated"),
            )

        return bind(F.struct(a.alias("a"), b.alias("b")), pair)

    return bind(F.struct(
        col(low).alias("low"), col(high).alias("high"),
        pay_period(period).alias("period"), known_currency(currency).alias("currency")), ordered)


def _plain_number(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("")).try_cast("double")


def extract_salary(c: ColumnOrName, honor_k: bool = True) -> Column:
    """Annualised salary found in free text, null when there is none.

    Three patterns are tried in order. With `honor_k` a `k` after a number of the
    first pattern means thousands; without it the mark is skipped over.
    """
    text, dollars, thousands, coded = col(c), fixed.DOLLAR_RANGE, fixed.THOUSANDS_RANGE, fixed.CODED_RANGE

    def times(value: Column, mark: Column) -> Column:
        return F.when(mark.isNotNull(), value * 1000).otherwise(value) if honor_k else value

    low1 = times(_plain_number(group(text, dollars, 1)), group(text, dollars, 2))
    high1 = times(_plain_number(group(text, dollars, 3)), group(text, dollars, 4))
    mark = F.lower(group(text, dollars, 5))
    period1 = (F.when(mark.isin("hour", "hr"), "hourly").when(mark == "month", "monthly")
               .otherwise("yearly"))
    low2 = group(text, thousands, 1).try_cast("double") * 1000
    high2 = group(text, thousands, 3).try_cast("double") * 1000
    low3, high3 = _plain_number(group(text, coded, 1)), _plain_number(group(text, coded, 2))

    def found(low: Column, high: Column, period: Column) -> Column:
        both = low.isNotNull() & high.isNotNull()
        return F.when(both, F.struct(low.alias("low"), high.alias("high"), period.alias("period")))

    raw = F.coalesce(found(low1, high1, period1), found(low2, high2, F.lit("yearly")),
                     found(low3, high3, F.lit("yearly")))
    # Only a digit next to a dollar sign or a currency code can match.
    worth = text.rlike(r"(?i)\$\s*[\d.,]|\d\s*(?:USD|EUR|GBP|CAD)")
    return F.when(worth, bind(raw, lambda s: F.when(
        s.isNotNull(), annualize_salary(s["low"], s["high"], s["period"], F.lit("USD")))))


def extract_salary_interval(c: ColumnOrName, annual: bool = False, lower: int = 1000,
                            upper: int = 700_000, hourly_below: int = 350,
                            monthly_below: int = 30_000) -> Column:
    """Salary range of a text with the interval inferred from its size.

    Struct of interval, min_amount, max_amount, currency; null when no range is
    plausible. `annual` gives yearly amounts instead of the written ones.
    """
    text, pattern = col(c), fixed.INTERVAL_RANGE
    low = F.floor(_plain_number(group(text, pattern, 1))).cast("long")
    high = F.floor(_plain_number(group(text, pattern, 3))).cast("long")
    factor = F.when(group(text, pattern, 2).isNotNull() | group(text, pattern, 4).isNotNull(),
                    1000).otherwise(1)

    def sized(s: Column) -> Column:
        interval = (F.when(s["low"] < hourly_below, "hourly")
                    .when(s["low"] < monthly_below, "monthly").otherwise("yearly"))
        times = (F.when(s["low"] < hourly_below, 2080)
                 .when(s["low"] < monthly_below, 12).otherwise(1))
        ceiling = (F.when(s["low"] < hourly_below, s["high"] < hourly_below)
                   .when(s["low"] < monthly_below, s["high"] < monthly_below).otherwise(True))
        year_low, year_high = s["low"] * times, s["high"] * times
        sane = (ceiling & year_low.between(lower, upper) & year_high.between(lower, upper)
                & (year_low < year_high))
        return F.when(sane, F.struct(
            interval.alias("interval"),
            (year_low if annual else s["low"]).alias("min_amount"),
            (year_high if annual else s["high"]).alias("max_amount"),
            F.lit("USD").alias("currency")))

    return bind(F.struct((low * factor).alias("low"), (high * factor).alias("high")), sized)


def yearly_amount(amount: ColumnOrName, interval: ColumnOrName) -> Column:
    """Amount of an interval as a yearly amount; unknown intervals are left alone."""
    return col(amount) * F.coalesce(lookup(PER_YEAR, col(interval)), F.lit(1))


def salary_source(direct: ColumnOrName, described: ColumnOrName) -> Column:
    """Where a row's salary came from, given the two candidate minimums."""
    return (F.when(F.coalesce(col(direct), F.lit(0)) != 0, "direct_data")
            .when(col(direct).isNull() & (F.coalesce(col(described), F.lit(0)) != 0), "description"))


# Context marks of salary text.
UP_TO = r"(?i)\b(?:up\s+to|maximum\s+of|max\s+of|not\s+more\s+than)\b"
STARTING = r"(?i)\b(?:from|starting\s+at|minimum\s+of|min\s+of|at\s+least)\b"
BY_HOUR = r"(?i)\b(?:per\s+hour|hourly|/hour|/hr)\b"
BY_MONTH = r"(?i)\b(?:per\s+month|monthly|/month|/mo)\b"
EXTRAS = r"(?i)\b(bonus|equity|stock|rsu)\b.*\d|\d.*\b(bonus|equity|stock|rsu)\b"
NUM = r"(\d+(?:\.\d+)?)"


def _price(text: Column) -> Column:
    """First amount of a text, one next to a currency sign preferred."""
    raw = F.coalesce(group(text, r"[£$€¥¢₹]\s*(\d[\d.,]*)"), group(text, r"(\d[\d.,]*)"))
    raw = F.regexp_replace(raw, r"[.,]+$", "")
    whole = F.regexp_replace(F.regexp_replace(raw, r"[.,]\d{1,2}$", ""), "[.,]", "")
    return whole.try_cast("long")


def parse_salary_text(c: ColumnOrName) -> Column:
    """Struct of min_salary and max_salary read from salary text.

    Tried in order: ranges with a `k`, two prices around a range mark, one number
    with a `k`, one price. Single values follow `up to` / `from`; hourly and
    monthly amounts become yearly.
    """
    text = F.regexp_replace(col(c), r"^\s+|\s+$", "")
    k_ranges = [rf"(?i){NUM}\s*k\s+to\s+{NUM}\s*k", rf"{NUM}\s*-\s*{NUM}\s*[kK]",
                rf"{NUM}[kK]\s*-\s*{NUM}[kK]", rf"{NUM}[kK]\s*-\s*{NUM}"]

    def thousands(value: Column) -> Column:
        return F.floor(value.try_cast("double") * 1000).cast("long")

    def k_pair(pattern: str) -> Column:
        a, b = thousands(group(text, pattern, 1)), thousands(group(text, pattern, 2))
        return F.when((a != 0) & (b != 0), F.struct(
            F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")))

    has_range = text.rlike(r"(?i)range|to|between|from|[-–—]")
    parts = F.filter(
        F.transform(F.split(text, r"(?i)\s*[-–—]\s*|\s+to\s+|\s+between\s+"),
                    lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")),
        lambda p: (F.length(p) >= 2) & p.rlike(r"\d") & ~p.rlike(EXTRAS))

    def part_value(p: Column) -> Column:
        by_k = thousands(group(p, rf"{NUM}\s*[kK]\b"))
        price = _price(p)
        return F.coalesce(by_k, F.when(price >= 10, price))

    def two_prices(ps: Column) -> Column:
        values = F.filter(F.transform(ps, part_value), lambda v: v.isNotNull())
        fits = has_range & F.size(ps).between(2, 3)
        return F.when(fits, bind(values, lambda vs: F.when(F.size(vs) >= 2, F.struct(
            F.array_min(vs).alias("lo"), F.array_max(vs).alias("hi")))))

    single = F.coalesce(thousands(group(text, rf"{NUM}\s*[kK]\b")), _price(text))
    lone = F.when(single.isNotNull(), F.struct(
        F.when(~text.rlike(UP_TO), single).alias("lo"),
        F.when(text.rlike(UP_TO) | ~text.rlike(STARTING), single).alias("hi")))
    times = F.when(text.rlike(BY_HOUR), 40 * 52).when(text.rlike(BY_MONTH), 12).otherwise(1)
    best = F.coalesce(*[k_pair(p) for p in k_ranges], bind(parts, two_prices), lone)
    value = F.when(text.rlike(r"\d"), best)
    return bind(F.struct(value.alias("v"), times.alias("t")), lambda s: F.struct(
        (s["v"]["lo"] * s["t"]).alias("min_salary"), (s["v"]["hi"] * s["t"]).alias("max_salary")))


def indian_salary(c: ColumnOrName) -> Column:
    """Lakh and crore ranges in rupees; null for anything else."""
    pattern, text = fixed.LAKH_RANGE, F.trim(col(c))
    unit = F.when(F.lower(group(text, pattern, 3)) == "cr", 10_000_000).otherwise(100_000)
    low, high = (F.floor(group(text, pattern, i).try_cast("double") * unit).cast("long") for i in (1, 2))
    return F.when(low.isNotNull(), F.struct(
        low.alias("min_amount"), high.alias("max_amount"), F.lit("INR").alias("currency")))


def range_cell(c: ColumnOrName) -> Column:
    """Salary cell such as `$1,000.00 - $2,000.00` as struct of currency and bounds."""
    text = F.trim(col(c))
    parts = F.split(text, "-")
    sign = F.substring(text, 1, 1)
    return F.when(F.length(text) > 0, F.struct(
        F.when(sign == "$", "USD").otherwise(sign).alias("currency"),
        number_text(parts[0]).cast("long").alias("min_amount"),
        number_text(F.get(parts, F.lit(1))).cast("long").alias("max_amount")))


def _grouped(c: Column) -> Column:
    return F.format_number(c.cast("long"), 0)


def salary_range_label(low: ColumnOrName, high: ColumnOrName, per_year: bool = False) -> Column:
    """Salary pair as display text; `per_year` gives the form with a `/year` ending."""
    a, b = F.nullif(col(low), F.lit(0)), F.nullif(col(high), F.lit(0))
    end = F.lit("/year" if per_year else "")
    both = F.concat(F.lit("$"), _grouped(a), F.lit(" - $"), _grouped(b), end)
    if not per_year:
        both = F.when(a == b, F.concat(F.lit("$"), _grouped(a))).otherwise(both)
    return (
        F.when(a.isNotNull() & b.isNotNull(), both)
        .when(a.isNotNull(), F.concat(F.lit("$"), _grouped(a), F.lit("+"), end))
        .when(b.isNotNull(), F.concat(F.lit("Up to $"), _grouped(b), end))
        .otherwise("Not specified")
    )


def salary_compact(c: ColumnOrName) -> Column:
    """Amount with a k or M ending."""
    whole = F.when(col(c) > 0, F.floor(col(c)).cast("long")).otherwise(F.lit(0).cast("long"))
    return (
        F.when(whole < 1000, F.concat(F.lit("$"), whole.cast("string")))
        .when(whole < 1_000_000, F.concat(F.lit("$"), F.floor(whole / 1000).cast("string"), F.lit("k")))
        .otherwise(F.concat(F.lit("$"), F.format_string("%.1f", whole / F.lit(1_000_000.0)), F.lit("M")))
    )


PAY_SCHEMA = ("baseSalary:struct<unitOfWork:string,range:struct<min:double,max:double>>,"
              "currencyCode:string,estimated:struct<currencyCode:string,"
              "baseSalary:struct<unitOfWork:string,range:struct<min:double,max:double>>>")
UNIT_INTERVALS = {"DAY": "daily", "YEAR": "yearly", "HOUR": "hourly", "WEEK": "weekly",
                  "MONTH": "monthly"}


def nested_compensation(pay: ColumnOrName) -> Column:
    """Pay struct of a board posting: base pay, else the estimate."""
    p = col(pay)
    base = F.coalesce(p["baseSalary"], p["estimated"]["baseSalary"])
    interval = lookup(UNIT_INTERVALS, F.upper(base["unitOfWork"]))
    return F.when(interval.isNotNull(), F.struct(
        interval.alias("interval"),
        base["range"]["min"].cast("long").alias("min_amount"),
        base["range"]["max"].cast("long").alias("max_amount"),
        F.when(p["estimated"].isNotNull(), p["estimated"]["currencyCode"])
        .otherwise(p["currencyCode"]).alias("currency")))


def percentile_compensation(period: ColumnOrName, p10: ColumnOrName, p90: ColumnOrName,
                            currency: ColumnOrName) -> Column:
    """Pay given as tenth and ninetieth percentile of an adjusted range."""
    names = {"ANNUAL": "yearly", "YEAR": "yearly", "HOUR": "hourly", "YEARLY": "yearly",
             "MONTHLY": "monthly", "WEEKLY": "weekly", "DAILY": "daily", "HOURLY": "hourly"}
    return F.when(col(period).isNotNull() & col(p10).isNotNull() & col(p90).isNotNull(), F.struct(
        lookup(names, col(period)).alias("interval"),
        F.floor(col(p10)).cast("long").alias("min_amount"),
        F.floor(col(p90)).cast("long").alias("max_amount"),
        F.coalesce(col(currency), F.lit("USD")).alias("currency")))


