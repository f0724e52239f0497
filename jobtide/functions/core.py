"""Small helpers shared by the column rules."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sql(value: object) -> str:
    """A constant as SQL text."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def literal_map(values: Mapping[str, object]) -> Column:
    """A constant map column, handed to Spark as one expression."""
    return F.expr("map(" + ", ".join(_sql(x) for kv in values.items() for x in kv) + ")")


def literal_array(values: Iterable[object]) -> Column:
    """A constant array column, handed to Spark as one expression."""
    return F.expr("array(" + ", ".join(_sql(x) for x in values) + ")")


def one_of(c: Column, values: Iterable[str]) -> Column:
    """Membership in a longer fixed list; null counts as no member."""
    return F.coalesce(F.array_contains(literal_array(values), c), F.lit(False))


def lookup(values: Mapping[str, object], key: Column) -> Column:
    """Value of a small fixed table, null for unknown keys."""
    return F.try_element_at(literal_map(values), key)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and hand it to `use`, which may read it many times."""
    return F.transform(F.array(value), use)[0]


def strip(c: ColumnOrName) -> Column:
    """Trim any white space, not only blanks."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def collapse(c: ColumnOrName) -> Column:
    """Trim and make every run of white space one blank."""
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


def blank(c: ColumnOrName) -> Column:
    """Null, empty or only white space."""
    return F.coalesce(strip(c) == "", F.lit(True))


def contains_any(text: Column, words: list[str]) -> Column:
    """Whether text holds one of the words; stops at the first hit."""
    if len(words) > 3:
        return F.exists(literal_array(words), lambda w: text.contains(w))
    hit = text.contains(words[0])
    for word in words[1:]:
        hit = hit | text.contains(word)
    return hit


def any_word(words: list[str]) -> str:
    """Regex alternation of literal words, valid in Java and RE2."""
    import re

    return "|".join(re.sub(r"([.+*?()\[\]{}|\\^$])", r"\\\1", w) for w in words)


def group(text: Column, pattern: str, index: int = 1) -> Column:
    """Capture group of the first match, null where there is none."""
    return F.nullif(F.regexp_extract(text, pattern, index), F.lit(""))
