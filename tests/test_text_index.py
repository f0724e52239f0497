import random
import re

import pytest
from pyspark.sql import functions as F

from jobtide.operators import search, text_index
from jobtide.sources import versions

WORDS = ["data", "engineer", "engineers", "python", "remote", "the", "and", "über", "Zürich", "scala"]


def postings(n, seed):
    rng = random.Random(seed)
    say = lambda k: " ".join(rng.choice(WORDS) for _ in range(rng.randrange(k)))
    return {i: (say(6), say(40) if i % 7 else None, say(3), say(3)) for i in range(n)}


def table(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in rows.items()], "id long, title string, description string, company string, location string")


def plain_words(text):
    fold = str.maketrans("üÜ", "uu")
    return re.findall(r"\w+", (text or "").lower().translate(fold))


def by_hand(rows, test):
    return sorted(i for i, fields in rows.items() if any(test(plain_words(f)) for f in fields))


def ids(df):
    return sorted(r[0] for r in df.collect())


@pytest.fixture(scope="module")
def followed(spark, tmp_path_factory):
    """An index that followed three changes, and the rows as they are in the end."""
    rows = postings(120, 1)
    folder = str(tmp_path_factory.mktemp("index"))
    index = text_index.create(table(spark, {i: r for i, r in rows.items() if i < 80}), folder, stemmed=False, buckets=4)
    index = text_index.update(index, table(spark, {i: r for i, r in rows.items() if i >= 80}))
    changed = {i: r for i, r in postings(40, 2).items() if i % 2}
    rows |= changed
    index = text_index.update(index, table(spark, changed), removed=spark.range(0, 30, 10))
    rows |= {5: ("python data", None, "", "zurich")}
    index = text_index.update(index, table(spark, {5: rows[5]}))
    return index, {i: r for i, r in rows.items() if i % 10 or i >= 30}


def check(index, rows):
    bag = {i: [w for f in r for w in plain_words(f)] for i, r in rows.items()}
    assert index.note["docs"] == sum(bool(b) for b in bag.values()) and index.note["words"] == sum(map(len, bag.values()))
    assert index.counts(["data", "nothing"]) == {"data": sum("data" in b for b in bag.values())}
    assert {r["doc_id"]: r["length"] for r in index.lengths().collect()} == {i: len(b) for i, b in bag.items() if b}
    assert ids(index.having(every=["DATA"], some=["Über", "python"], none=["remote"])) == sorted(
        i for i, b in bag.items() if "data" in b and ({"uber", "python"} & set(b)) and "remote" not in b)
    assert ids(index.phrase("the data the")) == by_hand(rows, lambda ws: " the data the " in f" {' '.join(ws)} ")
    assert ids(index.in_field("title", "zurich")) == sorted(i for i, r in rows.items() if "zurich" in plain_words(r[0]))
    near = lambda ws: any(a == "data" and b == "scala" and abs(i - j) <= 3 for i, a in enumerate(ws) for j, b in enumerate(ws))
    assert ids(index.near("data", "scala", 2)) == by_hand(rows, near)
    assert ids(index.near("data", "data", 1)) == by_hand(rows, lambda ws: any(ws[i] == "data" == ws[j] for i in range(len(ws)) for j in range(i + 1, min(i + 3, len(ws)))))
    plain = search.build_index(table(index.spark, rows), stemmed=False)
    expected = {r["doc_id"]: round(r["rank"], 9) for r in search.ranked_search(plain, search.index_lengths(plain), ["data", "python"]).collect()}
    assert {r["doc_id"]: round(r["rank"], 9) for r in index.ranked("data python").collect()} == expected and expected


def test_a_stored_index_follows_its_rows(followed):
    index, rows = followed
    assert len(index.segments) == 4 and index.note["marks"]
    check(index, rows)


def test_merging_changes_no_answer(spark, followed, tmp_path):
    index, rows = followed
    old = text_index.TextIndex(spark, index.folder)
    merged = text_index.merge(index)
    assert len(merged.segments) == 1 and not merged.note["marks"]
    check(merged, rows)
    check(old, rows)  # a reader of the version before goes on
    again = text_index.merge(merged, keep=1)
    check(again, rows)
    assert versions.current(spark, index.folder)["segments"] == again.note["segments"]
    with pytest.raises(ValueError):
        text_index.TextIndex(spark, str(tmp_path))


def test_a_search_reads_its_buckets_alone(spark, tmp_path):
    index = text_index.create(table(spark, postings(30, 5)), str(tmp_path), stemmed=False, buckets=4)
    plan = index.ranked("data")._jdf.queryExecution().executedPlan().toString()
    (scan,) = re.findall(r"FileScan parquet.*?ReadSchema", plan, re.S)
    assert "PartitionFilters" in scan and "bucket" in scan and re.search(r"PushedFilters: \[.*term", scan)


def test_half_written_segments_do_not_show(spark, tmp_path):
    rows = postings(20, 3)
    index = text_index.create(table(spark, rows), str(tmp_path), stemmed=False, buckets=2)
    text_index._write_segment(search.build_index(table(spark, {1: ("lost", "lost", "", "")}), stemmed=False), str(tmp_path), index.note["next"], 2)
    index = text_index.TextIndex(spark, str(tmp_path))
    assert index.having(every=["lost"]).count() == 0
    index = text_index.update(index, table(spark, {1: ("found", None, None, None)}))
    assert index.having(every=["lost"]).count() == 0 and ids(index.having(every=["found"])) == [1]
    check(index, rows | {1: ("found", None, None, None)})


def test_stems_are_joined_back(spark, tmp_path):
    rows = {1: ("Engineers engineering engineer", "data", None, ""), 2: ("engine", "the remote position", "", ""), 3: (None, "remotely placed", None, None)}
    index = text_index.create(table(spark, rows), str(tmp_path), buckets=2)
    assert ids(index.having(every=["engineered"])) == [1, 2]
    assert {r["doc_id"]: r["tf"] for r in index.rows(index.terms("engineer")).collect()} == {1: 3, 2: 1}
    assert ids(index.matching("the remote positions")) == [2]
    assert ids(index.phrase("engineer engineer engineer")) == [1]


def test_an_index_of_nothing(spark, tmp_path):
    index = text_index.create(table(spark, {1: ("x", None, None, None)}).limit(0), str(tmp_path), buckets=2)
    assert index.ranked("data").collect() == [] and index.lengths().count() == 0
    index = text_index.update(index, table(spark, {1: ("data", None, None, None)}))
    assert ids(index.ranked("data")) == [1]


def test_phrase_work_is_linear(spark):
    rows = spark.range(1).select("id", F.concat_ws(" ", F.array_repeat(F.lit("the the data"), 20_000)).alias("title"))
    index = search.build_index(rows, ("title",), stemmed=False)
    assert ids(search.phrase_search(index, ["the", "the", "data", "the"])) == [0]
    assert ids(search.near_search(index, "data", "the", 0)) == [0]
    assert search.phrase_search(index, ["data", "data"]).count() == 0


def test_the_stem_twin_knows_the_same():
    """The stemmer in SQL beside the one in Python, over published pairs, made-up words and words of the tables."""
    import duckdb
    import pandas as pd

    from jobtide.catalog.search import stems_sql
    from jobtide.functions.stem import stem

    rng = random.Random(4)
    ends = ["", "s", "es", "ed", "ing", "y", "ly", "ational", "izer", "fulness", "iveness", "ement", "ion", "tion", "e", "ll", "eed", "ies", "sses", "ability", "ously", "al", "ate"]
    words = {rng.choice(["", "y", "st", "b", "ex"]) + "".join(rng.choice("aeioubcdlstyzwx") for _ in range(rng.randint(1, 6))) + rng.choice(ends) for _ in range(6000)}
    words |= {"caresses", "ponies", "hopping", "falling", "hissing", "filing", "sky", "happy", "relational", "probate", "rate", "cease", "controll", "roll", "agreed", "feed", "über", "x1", "a", "is", "sayyid"}
    terms = pd.DataFrame({"term": sorted(words)})
    with duckdb.connect() as db:
        db.register("terms", terms)
        found = dict(db.sql(f"with {stems_sql('terms')} select term, stem from stems").fetchall())
    assert {w: s for w, s in found.items() if s != stem(w)} == {} and set(found) == words


def test_postings_are_not_shuffled(spark, tmp_path):
    """Texts are dealt over tasks once; words are grouped, stemmed and written where their text is."""
    rows = table(spark, postings(30, 7))
    for stemmed in (False, True):
        plan = search.build_index(rows, stemmed=stemmed)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("regexp_extract_all") == 4  # each field's words are read once
    index = text_index.create(rows, str(tmp_path), stemmed=False, buckets=2)
    plan = search.field_postings(index.rows())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert index.rows().filter("lead").select("doc_id").distinct().count() == index.rows().filter("lead").count() == index.note["docs"]


def test_rows_of_one_key_are_one_document(spark):
    rows = spark.createDataFrame([(1, "data data"), (1, "the data"), (None, "x"), (None, "x y"), (2, "the"), (3, None)], "id long, title string")
    index = search.build_index(rows, ("title",), stemmed=False)
    found = {(r["doc_id"], r["term"]): (r["tf"], [h["pos"] for h in r["hits"]]) for r in index.collect()}
    assert found == {(1, "data"): (3, [0, 1, 1]), (1, "the"): (1, [0]), (None, "x"): (2, [0, 0]), (None, "y"): (1, [1]), (2, "the"): (1, [0])}
    assert index.filter("lead").count() == 3


@pytest.mark.parametrize("stemmed", [False, True])
def test_words_are_grouped_in_bounded_parts(spark, monkeypatch, stemmed):
    """Words are grouped as arrays, a bounded number at once, and a task sorts the postings of little text."""
    rows = {**postings(60, 9), 60: ("", None, "", None), 61: ("engineers engineer data", "data", None, "engineers")}
    parts = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(search, "TOKENS", 7)
    index = search.build_index(table(spark, rows), stemmed=stemmed)
    assert "MapInArrow" in parts(index) and "sort_array" not in parts(index)
    word = search.stem if stemmed else str
    expected = {}
    for i, r in rows.items():
        bag = [(word(w), f, at) for f, text in sorted(zip(text_index.FIELDS, r, strict=True)) for at, w in enumerate(plain_words(text))]
        for w, f, at in bag:
            expected.setdefault((i, w), (len(bag), []))[1].append((f, at))
    found = {(r["doc_id"], r["term"]): (r["length"], [(h["field"], h["pos"]) for h in r["hits"]]) for r in index.collect()}
    assert found == expected
    assert index.filter("tf <> size(hits)").count() == 0 and index.filter("lead").count() == len({i for i, _ in expected})
    assert search.TEXT_PER_TASK <= 8 << 20
