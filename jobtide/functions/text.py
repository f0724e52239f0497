"""Text, hash and URL rules as native column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .core import ColumnOrName, col, collapse, literal_array, strip

EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"


def strip_html(c: ColumnOrName) -> Column:
    """Replace tags with a blank, then decode the common entities."""
    out = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"<[^>]+>", " ")
    for entity, char in fixed.HTML_ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def plain_text(c: ColumnOrName) -> Column:
    """Readable text of an HTML fragment, null kept."""
    return F.when(col(c).isNotNull(), collapse(strip_html(c)))


def hash_form(c: ColumnOrName) -> Column:
    """Lower case, punctuation that varies and white space runs as one blank."""
    return F.trim(
        F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), r"[\s,.\-_/\\|]+", " ")
    )


def content_hash(
    title: ColumnOrName,
    company: ColumnOrName,
    location: ColumnOrName,
    mode: str = "strict",
) -> Column:
    """SHA-256 of title, company and location joined by a bar.

    `strict` lower-cases only; `normalised` also levels punctuation and blanks.
    """
    if mode == "strict":
        parts = [F.lower(F.coalesce(col(c), F.lit(""))) for c in (title, company, location)]
    elif mode == "normalised":
        parts = [hash_form(c) for c in (title, company, location)]
    else:
        raise ValueError(f"unknown hash mode {mode!r}")
    return F.sha2(F.concat_ws("|", *parts), 256)


def description_hash(c: ColumnOrName) -> Column:
    return F.sha2(hash_form(strip_html(c)), 256)


def change_hash(
    title: ColumnOrName,
    description: ColumnOrName,
    location: ColumnOrName,
    company_id: ColumnOrName,
    salary_min: ColumnOrName,
    salary_max: ColumnOrName,
    posted: ColumnOrName,
) -> Column:
    """MD5 of the scraped fields, used to see whether a posting changed."""
    def text(c: ColumnOrName) -> Column:
        return F.coalesce(col(c).cast("string"), F.lit(""))

    company = F.coalesce(F.nullif(col(company_id), F.lit(0)).cast("string"), F.lit("unknown"))
    low, high = (F.coalesce(F.nullif(col(c), F.lit(0)).cast("string"), F.lit(""))
                 for c in (salary_min, salary_max))
    has_pair = col(salary_min).isNotNull() | col(salary_max).isNotNull()
    salary = F.when(has_pair, F.concat(low, F.lit("-"), high)).otherwise("")
    micros = F.date_format(col(posted), "SSSSSS")
    stamp = F.when(col(posted).isNull(), "").otherwise(F.concat(
        F.date_format(col(posted), "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)),
    ))
    return F.md5(F.concat(text(title), text(description), text(location), company,
                          salary, stamp))


def posting_hash(title: ColumnOrName, description: ColumnOrName, link: ColumnOrName) -> Column:
    """MD5 given to a posting when it is first made."""
    return F.md5(F.concat_ws("|", *[F.coalesce(col(c), F.lit(""))
                                    for c in (title, description, link)]))


def normalize_url(c: ColumnOrName) -> Column:
    """URL form used for matching: lower case, no `www.`, tracking parameters,
    fragment or closing slash."""
    url = F.regexp_replace(F.lower(strip(F.coalesce(col(c), F.lit("")))), "#.*$", "")
    base = F.regexp_replace(F.substring_index(url, "?", 1), r"^([a-z][a-z0-9+.\-]*://)www\.", "$1")
    base = F.regexp_replace(base, r"^([a-z][a-z0-9+.\-]*://[^/]+)?(.*?)/+$", "$1$2")
    query = F.regexp_extract(url, r"\?(.*)$", 1)
    tracked = r"^(?:" + "|".join(fixed.TRACKING_PARAMS) + ")="
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.rlike(tracked)), "&")
    return F.when(kept == "", base).otherwise(F.concat(base, F.lit("?"), kept))


def hostname(c: ColumnOrName) -> Column:
    """Host of a URL without user and port, empty for empty input."""
    return F.regexp_extract(F.coalesce(col(c), F.lit("")),
                            r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)


def url_without_query(c: ColumnOrName) -> Column:
    return F.regexp_replace(col(c), r"\?[^#]*", "")


def second_level_domain(c: ColumnOrName) -> Column:
    """Last two labels of the network location."""
    netloc = F.regexp_extract(col(c), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.substring_index(netloc, ".", -2)


def emails(c: ColumnOrName) -> Column:
    """All e-mail addresses of a text; null where there is no text."""
    return F.when(F.length(col(c)) > 0, F.regexp_extract_all(col(c), F.lit(EMAIL), F.lit(0)))


def joined(c: ColumnOrName) -> Column:
    """Array as comma-separated text, null when empty."""
    return F.when(F.size(col(c)) > 0, F.array_join(col(c), ", "))


def printable(c: ColumnOrName) -> Column:
    """Keep printable ASCII and the ASCII white space."""
    return F.regexp_replace(col(c), r"[^\x20-\x7E\t\n\r\x0B\x0C]", "")


def provider_key(provider: ColumnOrName, key: ColumnOrName) -> Column:
    return F.concat_ws("_", col(provider), col(key))


def merge_descriptions(short: ColumnOrName, switching: ColumnOrName) -> Column:
    """Two optional sentences joined by a full stop."""
    return F.concat_ws(". ", F.nullif(col(short), F.lit("")), F.nullif(col(switching), F.lit("")))


def truncate(c: ColumnOrName, limit: int) -> Column:
    """Cut to `limit` characters, the last three being dots."""
    text = F.coalesce(col(c), F.lit(""))
    if limit <= 3:
        cut = F.lit("..."[:limit])
    else:
        cut = F.concat(F.substring(text, 1, limit - 3), F.lit("..."))
    return F.when(F.length(text) <= limit, text).otherwise(cut)


def block_list_text(c: ColumnOrName, limit: int = 150) -> Column:
    """Description as kept in block lists: cut with two dots."""
    return F.when(F.length(col(c)) > limit,
                  F.concat(F.substring(col(c), 1, limit), F.lit(".."))).otherwise(col(c))


def alias_equal(left: ColumnOrName, right: ColumnOrName) -> Column:
    """Same alias once hyphens, dots and one shared ending are ignored."""
    a, b = (F.regexp_replace(F.lower(col(c)), r"[-.]", "") for c in (left, right))
    endings = literal_array(fixed.ALIAS_ENDINGS)

    def cut(text: Column, ending: Column) -> Column:
        size = F.length(text) - F.length(ending)
        return F.when(F.endswith(text, ending), F.substring(text, F.lit(1), size)).otherwise(text)

    return (a == b) | F.exists(endings, lambda e: cut(a, e) == cut(b, e))


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters and their base letter, from Unicode decomposition."""
    source, target = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFKD", chr(code))
        if len(base) > 1 and all(unicodedata.combining(x) for x in base[1:]):
            source.append(chr(code))
            target.append(base[0])
    return "".join(source), "".join(target)


ACCENTED, PLAIN = _accent_table()


def fold(c: ColumnOrName) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(col(c)), ACCENTED, PLAIN)
