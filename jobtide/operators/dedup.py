"""Exact duplicates, key reports and seen-set differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import blank, lookup
from ..functions.text import alias_equal, normalize_url
from ..session import kept
from .keyed import keep_first
from .similarity import find_near_duplicates

RANKS = {"hash": 1, "external_id": 2, "url": 3}


def match_keys(df: DataFrame, *columns: str) -> DataFrame:
    """One row per usable match key of each posting."""
    external = F.when(F.col("source_id").isNotNull() & ~blank("external_id"),
                      F.concat_ws("\x1f", F.col("source_id").cast("string"), "external_id"))
    values = {"hash": F.nullif(F.col("content_hash"), F.lit("")), "external_id": external,
              "url": F.nullif(normalize_url("url"), F.lit(""))}
    entries = F.array(*[
        F.struct(F.lit(RANKS[kind]).alias("rank"), F.lit(kind).alias("kind"), value.alias("key"))
        for kind, value in values.items()])
    # Rows without a key never reach the join, so nulls cannot pile up in one task.
    return df.select(*columns, F.inline(entries)).filter("key is not null")


def match_index(existing: DataFrame, order: str = "id") -> DataFrame:
    """Owner of each match key: the row loaded last."""
    return match_keys(existing, *dict.fromkeys(["id", order])).groupBy("rank", "kind", "key").agg(
        F.max_by("id", order).alias("original_id"))


def find_exact_duplicates(new: DataFrame, existing: DataFrame, order: str = "id") -> DataFrame:
    """Match table of new postings that exist already.

    Content hash counts before (source, external id), which counts before URL.
    Columns: duplicate_id, original_id, match_type, similarity.
    """
    return match_by_keys(match_keys(new, "id"), match_index(existing, order))


def match_by_keys(keys: DataFrame, index: DataFrame) -> DataFrame:
    """Match table of the postings whose match keys an index holds; the strongest kind of key counts."""
    hits = keys.withColumnRenamed("id", "duplicate_id").join(index, ["rank", "kind", "key"])
    # Plain numbers only, so that the aggregate hashes and needs no sort.
    best = hits.groupBy("duplicate_id").agg(
        F.min("rank").alias("rank"), F.min_by("original_id", "rank").alias("original_id"))
    kinds = {rank: kind for kind, rank in RANKS.items()}
    return best.select("duplicate_id", "original_id", lookup(kinds, F.col("rank")).alias("match_type"),
                       F.lit(1.0).alias("similarity"))


def find_all_duplicates(new: DataFrame, existing: DataFrame, near: bool = True,
                        **near_options) -> tuple[DataFrame, DataFrame]:
    """Unique new postings, and the match table of the others.

    Near duplicates are looked for only among rows without an exact match.
    """
    matches = find_exact_duplicates(new, existing)
    if near:
        rest = new.join(matches.select(F.col("duplicate_id").alias("id")), "id", "left_anti")
        matches = matches.unionByName(find_near_duplicates(rest, existing, **near_options))
    unique = new.join(matches.select(F.col("duplicate_id").alias("id")), "id", "left_anti")
    return unique, matches


def first_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    return keep_first(rows, [key], [order])


def provider_clashes(rows: DataFrame, key: str = "key_id", provider: str = "provider") -> DataFrame:
    """Keys that more than one provider uses."""
    return (rows.groupBy(key).agg(F.countDistinct(provider).alias("providers"))
            .filter("providers > 1"))


def distinct_links(rows: DataFrame, link: str = "link", order: str = "id") -> DataFrame:
    """Drop blank links, keep the first row of each link."""
    return keep_first(rows.filter(~blank(link)), [link], [order])


def new_postings(batch: DataFrame, seen: DataFrame, key: str = "key", url: str = "url",
                 order: str = "id") -> DataFrame:
    """Postings whose key was never seen, as if taken one by one in a unique order: a posting is taken
    unless one taken before it has its key or its URL.

    A round takes every posting that is the first of its key and of its URL, and drops the others that
    share either with a taken one. Rounds go on while postings are left; their number is the length
    of the longest chain of postings that hide each other, not the number of postings.
    """
    left = kept(batch.filter(~blank(key)).join(seen.select(key), key, "left_anti"), "unseen")
    taken = []
    while not taken or not left.isEmpty():
        first = [left.groupBy(c).agg(F.min(order).alias("_first")).select("_first") for c in (key, url)]
        taken.append(kept(reduce(lambda rows, of: rows.join(of, F.col(order) == F.col("_first"), "left_semi"), first, left), "taken"))
        urls = taken[-1].select(F.col(url).alias("_url"))
        left = kept(left.join(taken[-1].select(key), key, "left_anti")
                    .join(urls, F.col(url).eqNullSafe(F.col("_url")), "left_anti"), "unseen")
    return reduce(DataFrame.unionByName, taken).select(*batch.columns)


def append_seen(seen: DataFrame, fresh: DataFrame, key: str = "key", found_at: str = "found_at") -> DataFrame:
    return seen.select(key, found_at).unionByName(fresh.select(key, found_at))


def index_statistics(postings: DataFrame) -> DataFrame:
    """Sizes of the match indexes of a table, in one pass."""
    keys = match_keys(postings, "id").groupBy("kind", "key").agg(F.lit(1).alias("one")).groupBy("kind").count()
    pick = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("count"))), F.lit(0))
    return keys.agg(pick("hash").alias("hashes"), pick("external_id").alias("external_ids"),
                    pick("url").alias("urls"))


def url_reuse(vacancies: DataFrame) -> DataFrame:
    """URLs used by several companies, or twice for one company and language."""
    per_use = vacancies.groupBy("url", "alias", "language").agg(F.count("*").alias("uses"))
    return (
        per_use.groupBy("url").agg(F.countDistinct("alias").alias("companies"),
                                   F.max("uses").alias("most_uses"))
        .filter("companies > 1 or most_uses > 1")
        .withColumn("problem", F.when(F.col("companies") > 1, "several companies").otherwise("repeated"))
    )


def alias_agreement(companies: DataFrame, left: str, right: str) -> DataFrame:
    """Each company's second alias as empty, same or different."""
    verdict = (F.when(blank(right), "empty").when(alias_equal(left, right), "same")
               .otherwise("different"))
    return companies.filter(~F.col("ignore")).select(
        F.col(left).alias("left_alias"), F.col(right).alias("right_alias"), verdict.alias("verdict"))


def first_per_site(rows: DataFrame, site: str, key: str, order: str) -> DataFrame:
    """First posting of each URL or id within a site."""
    return keep_first(rows, [site, key], [order])


