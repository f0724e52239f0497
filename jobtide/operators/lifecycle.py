"""Posting state over snapshots: upsert, sync, archive, retire, history.

Parquet has no MERGE, so each operator returns the next full snapshot with an
`action` per row; the caller writes it as a new version beside the old one.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import blank
from ..functions.text import change_hash
from ..session import hashed, kept
from .keyed import keep_first, keep_last, numbered, with_previous


def _old(name: str) -> Column:
    return F.col(f"old.{name}")


def _new(name: str) -> Column:
    return F.col(f"new.{name}")


def with_new_ids(fresh: DataFrame, base: DataFrame, order: str, key: str = "id") -> DataFrame:
    """Ids for rows that have none: after the largest id in use, in `order`."""
    top = base.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    return numbered(fresh.drop(key), order, F.lit(top).cast("long"), key)


def marked_arrivals(arrivals: DataFrame, base: DataFrame, key: str, used: Sequence[str] = ()) -> DataFrame:
    """The batch's rows, one per key, with whether the stored table has the key; written once for the steps that follow.

    Of a known row these use the key and the columns `used`; the others are left empty.
    """
    known = base.select(key).distinct().withColumn("_known", F.lit(True))
    marked = arrivals.join(known, key, "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    held = (key, "_known", *used)
    return kept(marked.select(*[c if c in held else F.when(~F.col("_known"), F.col(c)).alias(c) for c in marked.columns]), "arrivals", compression="zstd")


def upsert_jobs(base: DataFrame, batch: DataFrame, now: datetime, order: str = "seq") -> DataFrame:
    """Next snapshot after a batch keyed by content hash.

    A known posting is seen again and active; an unknown one is inserted with the
    next id. `action` is kept, updated or inserted.
    """
    moment = F.lit(now)
    arrivals = marked_arrivals(keep_first(batch, ["content_hash"], [order]), base, "content_hash")
    seen = arrivals.filter("_known").select("content_hash").withColumn("_seen", F.lit(True))
    touched = base.join(hashed(seen), "content_hash", "left").withColumn("_seen", F.coalesce("_seen", F.lit(False)))
    stay = touched.select(*[
        {"last_seen_at": F.when(F.col("_seen"), moment).otherwise(F.col("last_seen_at")),
         "updated_at": F.when(F.col("_seen"), moment).otherwise(F.col("updated_at")),
         "is_active": F.col("_seen") | F.col("is_active")}.get(c, F.col(c)).alias(c)
        for c in base.columns], F.when(F.col("_seen"), "updated").otherwise("kept").alias("action"))
    added = with_new_ids(arrivals.filter("not _known").drop("_known"), base, order)
    stamps = {"first_seen_at": moment, "last_seen_at": moment, "created_at": moment,
              "updated_at": moment, "is_active": F.lit(True)}
    types = dict(base.dtypes)
    added = added.select(*[
        stamps.get(c, F.col(c) if c in added.columns else F.lit(None)).cast(types[c]).alias(c)
        for c in base.columns], F.lit("inserted").alias("action"))
    return stay.unionByName(added)


def mark_inactive(jobs: DataFrame, source_id: int, seen_before: datetime, now: datetime) -> DataFrame:
    """Switch off a source's active jobs that were not seen since a moment."""
    stale = (F.col("source_id") == source_id) & F.col("is_active") & (F.col("last_seen_at") < F.lit(seen_before))
    return (jobs.withColumn("action", F.when(stale, "deactivated").otherwise("kept"))
            .withColumn("updated_at", F.when(stale, F.lit(now)).otherwise(F.col("updated_at")))
            .withColumn("is_active", F.col("is_active") & ~stale))


def patch_rows(base: DataFrame, patch: DataFrame, key: str = "id") -> DataFrame:
    """Overlay the non-null fields of a sparse patch."""
    fields = [c for c in patch.columns if c != key]
    joined = base.alias("old").join(patch.alias("new"), key, "left")
    return joined.select(*[
        (F.col(key) if c == key else F.coalesce(_new(c), _old(c)) if c in fields else _old(c)).alias(c)
        for c in base.columns])


SCRAPED = ["title", "company_id", "description", "location", "posted_date", "salary_min", "salary_max"]


def scraped_hash() -> Column:
    return change_hash("title", "description", "location", "company_id", "salary_min", "salary_max",
                       "posted_date")


def has_user_data(favorite: Column, notes: Column, status: Column) -> Column:
    return F.coalesce(favorite, F.lit(False)) | ~blank(notes) | (F.coalesce(status, F.lit("New")) != "New")


def sync_jobs(base: DataFrame, snapshot: DataFrame, now: datetime, order: str = "seq") -> DataFrame:
    """Next tracker snapshot after a full scrape, keyed by link.

    New links are inserted, changed ones updated with user fields kept, unchanged
    ones skipped (or brought back from the archive). Links that vanished are
    archived when they carry user data and deleted otherwise. `action` names what
    happened; deleted rows are part of the result so that they can be counted.
    """
    moment = F.lit(now)
    arrivals = keep_first(snapshot.filter(~blank("link")), ["link"], [order]).withColumn(
        "content_hash", scraped_hash())
    arrivals = marked_arrivals(arrivals, base, "link", [*SCRAPED, "content_hash"])
    added = with_new_ids(arrivals.filter("not _known").drop("_known"), base, order)
    types = dict(base.dtypes)
    defaults = {"favorite": F.lit(False), "notes": F.lit(""), "archived": F.lit(False),
                "application_status": F.lit("New"), "last_seen": moment}
    added = added.select(*[
        defaults.get(c, F.col(c) if c in added.columns else F.lit(None)).cast(types[c]).alias(c)
        for c in base.columns], F.lit("inserted").alias("action"))
    there = base.alias("old").join(
        arrivals.filter("_known").select("link", *SCRAPED, "content_hash", F.lit(True).alias("_here")).alias("new"), "link", "left")
    here = F.coalesce(_new("_here"), F.lit(False))
    changed = here & ~_old("content_hash").eqNullSafe(_new("content_hash"))
    user = has_user_data(_old("favorite"), _old("notes"), _old("application_status"))
    action = (
        F.when(changed | (here & _old("archived")), "updated").when(here, "skipped")
        .when(_old("archived"), "kept").when(user, "archived").otherwise("deleted")
    )
    values = {c: F.when(changed, _new(c)).otherwise(_old(c)) for c in [*SCRAPED, "content_hash"]}
    values["last_seen"] = F.when(here, moment).otherwise(_old("last_seen"))
    values["archived"] = ~here & (_old("archived") | user)
    values["link"] = F.col("link")
    stay = there.select(*[values.get(c, _old(c)).alias(c) for c in base.columns], action.alias("action"))
    return stay.unionByName(added)


def sync_counts(synced: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Inserted, updated, skipped, archived and deleted of a sync, as one row.

    Repeated links of the batch count as skipped.
    """
    repeats = (snapshot.filter(~blank("link")).groupBy("link").agg((F.count("*") - 1).alias("n"))
               .select(F.lit("skipped").alias("action"), "n"))
    moves = synced.groupBy("action").agg(F.count("*").alias("n")).unionByName(repeats)
    return moves.agg(*[
        F.coalesce(F.sum(F.when(F.col("action") == a, F.col("n"))), F.lit(0)).alias(a)
        for a in ("inserted", "updated", "skipped", "archived", "deleted")])


def handle_stale(base: DataFrame, current: DataFrame) -> DataFrame:
    """Archive or delete unarchived rows whose link is gone; deleted rows drop out."""
    gone = base.filter(~F.col("archived")).join(current.select("link"), "link", "left_anti")
    user = has_user_data(F.col("favorite"), F.col("notes"), F.col("application_status"))
    there = base.filter("archived").unionByName(
        base.filter(~F.col("archived")).join(current.select("link"), "link", "left_semi"))
    return there.withColumn("action", F.lit("kept")).unionByName(
        gone.filter(user).withColumn("archived", F.lit(True)).withColumn("action", F.lit("archived")))


def retire_old(jobs: DataFrame, now: datetime, days: int = 90) -> DataFrame:
    """Drop archived rows neither seen nor applied to for a long time."""
    cutoff = F.lit(now - timedelta(days=days))
    old = (F.col("archived") & (F.col("last_seen") < cutoff)
           & (F.col("application_date").isNull() | (F.col("application_date") < cutoff)))
    return jobs.filter(~F.coalesce(old, F.lit(False)))


def edit_jobs(jobs: DataFrame, edits: DataFrame, now: datetime) -> DataFrame:
    """Apply user edits by id; the first change to Applied sets the application date."""
    edited = patch_rows(jobs.withColumn("_before", F.col("application_status")), edits)
    applied = (F.col("application_status") == "Applied") & (F.col("_before") != "Applied")
    first = applied & F.col("application_date").isNull()
    return edited.withColumn(
        "application_date", F.when(first, F.lit(now)).otherwise(F.col("application_date"))).drop("_before")


def update_if_newer(master: DataFrame, matches: DataFrame, incoming: DataFrame) -> DataFrame:
    """Replace master rows by matched incoming ones that are at least as new.

    Of several matches the newest counts, the later one on equal dates. The title
    of the master row stays.
    """
    fields = [c for c in incoming.columns if c not in ("id", "title")]
    offers = matches.filter("original_id is not null").select(
        F.col("original_id"), F.col("duplicate_id").alias("id")).join(incoming, "id")
    offers = keep_last(offers, ["original_id"], ["post_date", "id"])
    joined = master.alias("old").join(offers.select(
        F.col("original_id").alias("id"), *fields, F.lit(True).alias("_there")).alias("new"), "id", "left")
    newer = F.coalesce(_new("_there") & (_new("post_date") >= _old("post_date")), F.lit(False))
    return joined.select(*[
        (F.when(newer, _new(c)).otherwise(_old(c)) if c in fields else
         F.col("id") if c == "id" else _old(c)).alias(c)
        for c in master.columns], newer.alias("updated"))


def grow_block_list(block_list: DataFrame, master: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Add rows the user gave a removing status to the block list."""
    fresh = master.filter(F.col("status").isin(*statuses)).select(*block_list.columns)
    return block_list.unionByName(fresh.join(block_list.select("key_id"), "key_id", "left_anti"))


def switch_state(events: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "active",
                 tie: str = "event_id") -> DataFrame:
    """State after on/off events that count only when they change something.

    Columns: keys, value, created_at (first event), updated_at (last change).
    """
    dated = events.withColumn("_day", F.to_date(ts))
    marked = with_previous(dated, keys, [ts, tie], value, "_day", "_before")
    change = F.col("_before").isNull() | (F.col("_before") != F.col(value))
    return marked.groupBy(*keys).agg(
        F.max_by(value, F.struct(ts, tie)).alias(value), F.min(ts).alias("created_at"),
        F.max(F.when(change, F.col(ts))).alias("updated_at"))


def latest_links(events: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "active",
                 tie: str = "event_id") -> DataFrame:
    """Bridge rows after soft deletes and returns: the latest event decides."""
    return events.groupBy(*keys).agg(
        F.max_by(value, F.struct(ts, tie)).alias(value), F.min(ts).alias("created_at"),
        F.max(ts).alias("updated_at"))


def get_or_create_companies(companies: DataFrame, wanted: DataFrame, order: str = "seq") -> DataFrame:
    """Company table with an id for every wanted name."""
    fresh = keep_first(wanted.filter(~blank("name")), ["name"], [order]).join(
        companies.select("name"), "name", "left_anti")
    added = with_new_ids(fresh, companies, order)
    return companies.select("id", "name").unionByName(added.select("id", "name"))


def stable_codes(codes: DataFrame, rows: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """Keep the code of known keys and number the others after the largest code.

    Ignored rows get no new code.
    """
    first = keep_first(rows, [key], [order])
    known = first.join(codes, key).select("id", key)
    fresh = first.filter(~F.col("ignore")).join(codes.select(key), key, "left_anti")
    return known.unionByName(with_new_ids(fresh, codes, order).select("id", key))


def insert_or_touch(base: DataFrame, batch: DataFrame, now: datetime, order: str = "seq") -> DataFrame:
    """Insert postings whose link is unknown; only the sight of the others is noted."""
    arrivals = marked_arrivals(keep_first(batch.filter(~blank("link")), ["link"], [order]), base, "link")
    seen = arrivals.filter("_known").select("link").withColumn("_seen", F.lit(True))
    stay = base.join(hashed(seen), "link", "left").withColumn(
        "last_seen", F.when(F.col("_seen"), F.lit(now)).otherwise(F.col("last_seen")))
    stay = stay.select(*base.columns, F.when(F.col("_seen"), "touched").otherwise("kept").alias("action"))
    added = with_new_ids(arrivals.filter("not _known").drop("_known"), base, order)
    types = dict(base.dtypes)
    added = added.select(*[
        (F.lit(now) if c == "last_seen" else F.col(c) if c in added.columns else F.lit(None))
        .cast(types[c]).alias(c) for c in base.columns], F.lit("inserted").alias("action"))
    return stay.unionByName(added)


def drop_empty_sources(sources: DataFrame, jobs: DataFrame) -> DataFrame:
    """Sources that have jobs; each task names its sources once, so that the jobs of a large one never meet in one task."""
    used = jobs.select(F.col("source_id").alias("id")).distinct()
    return sources.join(used, "id", "left_semi")


def switch_companies(companies: DataFrame, ids: DataFrame, active: bool | None) -> DataFrame:
    """Set the active flag of the named companies, or delete them with `None`."""
    if active is None:
        return companies.join(ids.select("id"), "id", "left_anti")
    chosen = ids.select("id").distinct().withColumn("_chosen", F.lit(True))
    return (companies.join(chosen, "id", "left")
            .withColumn("active", F.when(F.col("_chosen"), F.lit(active)).otherwise(F.col("active")))
            .select(*companies.columns))


def profile_changes(events: DataFrame, key: str = "profile_id", ts: str = "ts",
                    tie: str = "event_id") -> DataFrame:
    """Events that change a profile; `history` marks changes beyond letter case."""
    wide = events.withColumn("_p", F.struct("email", "username", "name")).withColumn("_day", F.to_date(ts))
    seen = with_previous(wide, [key], [ts, tie], "_p", "_day", "_before").filter("_before is not null")
    fold = lambda s, f: F.lower(F.coalesce(F.col(f"{s}.{f}"), F.lit("")))
    plain = lambda s, f: F.coalesce(F.col(f"{s}.{f}"), F.lit(""))
    same_mail = fold("_p", "email") == fold("_before", "email")
    changed = ~same_mail | (plain("_p", "username") != plain("_before", "username")) | (
        plain("_p", "name") != plain("_before", "name"))
    beyond = ~same_mail | (fold("_p", "username") != fold("_before", "username")) | (
        fold("_p", "name") != fold("_before", "name"))
    return seen.withColumn("history", beyond).filter(changed).select(
        key, ts, F.lower("email").alias("email"), "username", "name", "history")
