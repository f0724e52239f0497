import random
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobtide.operators import dedup, keyed, lifecycle, search, series, similarity
from jobtide.operators.filters import salary_overlap
from jobtide.sources import lists, sinks


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_keep_first_and_last_agree_with_python(spark):
    random.seed(1)
    data = [(random.choice("aab"), i, str(i)) for i in random.sample(range(300), 300)]
    df = spark.createDataFrame(data, "k string, n int, v string").repartition(7)
    first, last = {}, {}
    for k, n, v in sorted(data, key=lambda r: r[1]):
        first.setdefault(k, (k, n, v))
        last[k] = (k, n, v)
    assert rows(keyed.keep_first(df, ["k"], ["n"]), "k", "n", "v") == sorted(first.values())
    assert rows(keyed.keep_last(df, ["k"], ["n"]), "k", "n", "v") == sorted(last.values())


def test_numbers_are_dense_and_in_order(spark):
    keys = sorted(random.Random(2).sample(range(10_000), 500))
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    out = keyed.numbered(df, "k", F.lit(40), "id", width=64)
    assert rows(out, "k", "id") == [(k, 41 + i) for i, k in enumerate(keys)]


def test_previous_value_over_buckets(spark):
    rng = random.Random(3)
    data = [(rng.choice([1, 1, 1, 2]), i, rng.random() < 0.5) for i in range(400)]
    df = spark.createDataFrame(data, "k int, n int, v boolean").withColumn("b", (F.col("n") / 13).cast("int")).repartition(6)
    before, expected = {}, []
    for k, n, v in data:
        expected.append((n, before.get(k)))
        before[k] = v
    out = keyed.with_previous(df, ["k"], ["n"], "v", "b")
    assert sorted(((r.n, r.previous) for r in out.collect())) == expected


def test_sparse_and_missing_order_values_are_numbered(spark):
    rng = random.Random(4)
    keys = sorted({rng.randrange(-2**62, 2**62) for _ in range(200)})
    df = spark.createDataFrame([(k,) for k in [*keys, None]], "k long").repartition(5)
    got = {r.k: r.id for r in keyed.numbered(df, "k", F.lit(0), "id", width=100).collect()}
    assert got == {k: i + 1 for i, k in enumerate([*keys, None])}


def test_previous_value_keeps_rows_without_key_or_time(spark):
    data = [(1, 1, True, 0), (1, 2, False, 0), (None, 3, True, 0), (None, 4, False, 1), (1, None, True, None)]
    df = spark.createDataFrame(data, "k int, n int, v boolean, b int")
    got = {(r.k, r.n): r.previous for r in keyed.with_previous(df, ["k"], ["n"], "v", "b").collect()}
    assert got == {(1, None): None, (1, 1): True, (1, 2): True, (None, 3): None, (None, 4): True}


def test_new_postings_as_one_by_one(spark):
    rng = random.Random(5)
    data = [(i, rng.choice("ABCDEFGH "), rng.choice(["u1", "u2", "u3", "u4", "u5", None])) for i in range(60)]
    cases = [[(1, "A", "u1"), (2, "K", "u1"), (3, "K", "u2")], [(1, "K", "u1"), (2, "K", "u2"), (3, "B", "u2")], data, []]
    seen = spark.createDataFrame([("H",)], "key string")
    for case in cases:
        keys, urls, expected = {"H", " "}, set(), []
        for i, key, url in case:
            if key not in keys and url not in urls:
                expected.append(i)
                keys.add(key)
                urls.add(url)
        batch = spark.createDataFrame(case, "id long, key string, url string")
        assert sorted(r.id for r in dedup.new_postings(batch, seen).collect()) == expected


def postings(spark, data):
    return spark.createDataFrame(data, "id long, content_hash string, source_id long, external_id string, url string")


def test_exact_duplicates_by_priority_and_partitioning(spark):
    existing = postings(spark, [(1, "h1", 1, "e1", "http://a/1"), (2, "h2", 1, "e2", "http://a/2"), (3, "h1", 2, "e3", "http://www.a/3")])
    new = postings(spark, [(10, "h1", 9, "zz", "http://q"), (11, "xx", 1, "e2", "http://a/1"), (12, "yy", 9, None, "http://a/3/?ref=x"),
                           (13, "new", None, "e1", None), (14, "", 1, "", "")])
    expected = [(10, 3, "hash"), (11, 2, "external_id"), (12, 3, "url")]
    for parts in (1, 5):
        found = dedup.find_exact_duplicates(new.repartition(parts), existing.repartition(parts))
        assert rows(found, "duplicate_id", "original_id", "match_type") == expected
    unique, _ = dedup.find_all_duplicates(new, existing, near=False)
    assert rows(unique, "id") == [(13,), (14,)]


def brute_force(new, existing, threshold, max_features, bigrams, both=False):
    """Plain TF-IDF over all pairs."""
    import math
    import re
    from collections import Counter

    def grams(text):
        ws = re.findall(r"\w{2,}", text.lower())
        return ws + ([" ".join(p) for p in zip(ws, ws[1:])] if bigrams else [])

    corpus = [grams(t) for _, t in existing] + ([grams(t) for _, t in new] if both else [])
    uses, df = Counter(), Counter()
    for g in corpus:
        uses.update(g)
        df.update(set(g))
    vocab = sorted(uses, key=lambda t: (-uses[t], t))[:max_features]
    n = len(corpus)

    def vector(text):
        tf = Counter(g for g in grams(text) if g in kept)
        v = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in tf.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()} if size else {}

    kept = set(vocab)
    refs = [(i, vector(t)) for i, t in sorted(existing)]
    out = []
    for i, t in new:
        v = vector(t)
        scores = [(round(sum(x * r.get(g, 0.0) for g, x in v.items()), 9), -j) for j, r in refs]
        best = max(scores)
        if best[0] >= threshold:
            out.append((i, -best[1], round(best[0], 6)))
    return sorted(out)


@pytest.mark.parametrize("max_features, bigrams, width", [(5000, True, 2048), (60, True, 3), (None, False, 1), (None, True, 2)])
def test_near_duplicates_match_brute_force(spark, monkeypatch, max_features, bigrams, width):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(80)]
    base = [[rng.choice(words) for _ in range(30)] for _ in range(12)]

    def near_copy(ws):
        ws = list(ws)
        for _ in range(rng.randint(0, 6)):
            ws[rng.randrange(len(ws))] = rng.choice(words)
        return " ".join(ws)

    # A third of the rows are copies of one text, another third near copies of it.
    existing = [(i, near_copy(base[0] if i % 3 else base[i % 12]) if i % 3 != 2 else " ".join(base[0])) for i in range(40)]
    new = [(100 + i, near_copy(base[0] if i % 2 else base[i % 12])) for i in range(25)]
    new += [(200 + i, " ".join(base[0])) for i in range(8)]
    monkeypatch.setattr(similarity.best_pairs, "__defaults__", (width,))
    schema = "id long, description string"
    found = similarity.find_near_duplicates(
        spark.createDataFrame(new, schema).repartition(3), spark.createDataFrame(existing, schema).repartition(3),
        max_features=max_features, bigrams=bigrams)
    got = sorted((r.duplicate_id, r.original_id, round(r.similarity, 6)) for r in found.collect())
    assert got == brute_force(new, existing, 0.75, max_features, bigrams)


def test_no_table_grows_with_the_pairs(spark, monkeypatch):
    """Every new text shares all its terms with every existing one; what is kept is as large as the texts, not as their pairs."""
    sizes = []

    def kept(df, name):
        out = keep(df, name)
        sizes.append(out.count())
        return out

    keep = similarity.kept
    monkeypatch.setattr(similarity, "kept", kept)
    say = lambda i: " ".join(w for w, n in zip(("data", "python", "scala", "remote"), (1 + i % 5, 1 + i // 5 % 5, 1 + i // 25 % 5, 3), strict=True) for _ in range(n))
    rows = spark.range(120).select("id", F.udf(say)("id").alias("description"))
    found = similarity.find_near_duplicates(rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1"), threshold=0.3, bigrams=False)
    assert found.count() == 60 and max(sizes) <= 120 * 4


@pytest.mark.parametrize("spread, share", [(3000, 0.02), (60, 1.0)])
def test_only_likely_pairs_are_measured(monkeypatch, spread, share):
    """Texts of unlike terms are told apart by their sketches; texts of like terms are all measured. Both give the true best, the first on ties."""
    rng, measured = np.random.default_rng(3), []
    dense = np.zeros((2, 300, 3000))
    for side in dense:
        for text in side:
            text[rng.choice(spread, 40, replace=False)] = rng.integers(1, 9, 40)
    dense[0, :30] = dense[1, 100:130]  # near copies, some of texts that are there twice
    dense[0, :30, 0] += 1
    dense[1, 200:215] = dense[1, 100:115]
    dense /= np.sqrt((dense * dense).sum(axis=2, keepdims=True))

    def block(side):
        texts, terms = np.nonzero(side)
        parts = similarity._Block.packed(np.bincount(texts, minlength=300), terms * (1 << 40), side[texts, terms])
        return similarity._Block(300, **{k: np.frombuffer(x, kind) for x, (k, kind) in zip(parts, similarity._Block.KINDS.items(), strict=True)})

    cosines = similarity._cosines
    monkeypatch.setattr(similarity, "_cosines", lambda new, ref: measured.append(new.n * ref.n) or cosines(new, ref))
    found, best, scores = similarity._best(block(dense[0]), block(dense[1]), np.full(300, 0.75))
    true = np.round(dense[0] @ dense[1].T, 12)
    rows = np.flatnonzero(true.max(axis=1) >= 0.75)
    assert found.tolist() == rows.tolist() and best.tolist() == true[rows].argmax(axis=1).tolist()
    assert np.abs(scores - true[rows].max(axis=1)).max() < 1e-11 and sum(measured) <= share * 300 * 300


def test_small_corpus_matches_nothing(spark):
    df = spark.createDataFrame([(i, "the same long description of one and the same job posting") for i in range(5)], "id long, description string")
    assert similarity.find_near_duplicates(df, df, min_corpus=25).count() == 0
    assert similarity.find_near_duplicates(df, df).count() == 5


TRACKER = ("id long, seq long, link string, title string, company_id long, description string, location string, posted_date timestamp,"
           " salary_min int, salary_max int, favorite boolean, notes string, application_status string, application_date timestamp,"
           " archived boolean, last_seen timestamp, content_hash string")


def tracker(spark, entries):
    day = datetime(2024, 1, 1)
    data = [(i, i, link, title, 1, "d", "l", day, 1, 2, fav, "", "New", None, arch, day, None) for i, link, title, fav, arch in entries]
    return spark.createDataFrame(data, TRACKER).withColumn("content_hash", lifecycle.scraped_hash())


def test_sync_actions_and_second_sync_skips(spark):
    now = datetime(2024, 2, 1)
    base = tracker(spark, [(1, "a", "A", False, False), (2, "b", "B", False, False), (3, "c", "C", True, False), (4, "d", "D", False, True),
                           (5, "e", "E", False, False)])
    batch = tracker(spark, [(1, "a", "A", False, False), (2, "b", "B2", False, False), (3, "d", "D", False, False), (4, "f", "F", False, False),
                            (5, "f", "F", False, False), (6, "", "G", False, False)])
    synced = lifecycle.sync_jobs(base, batch, now)
    assert rows(synced, "id", "link", "action", "archived") == [
        (1, "a", "skipped", False), (2, "b", "updated", False), (3, "c", "archived", True), (4, "d", "updated", False),
        (5, "e", "deleted", False), (6, "f", "inserted", False)]
    counts = lifecycle.sync_counts(synced, batch).first().asDict()
    assert counts == {"inserted": 1, "updated": 2, "skipped": 2, "archived": 1, "deleted": 1}
    again = lifecycle.sync_jobs(synced.filter("action <> 'deleted'").drop("action"), batch, now)
    assert {r.action for r in again.collect()} == {"skipped", "kept"}


def test_applied_date_is_set_once(spark):
    now = datetime(2024, 2, 1)
    jobs = tracker(spark, [(1, "a", "A", False, False), (2, "b", "B", False, False)])
    edits = spark.createDataFrame([(1, "Applied")], "id long, application_status string")
    once = lifecycle.edit_jobs(jobs, edits, now)
    assert rows(once, "id", "application_date") == [(1, now), (2, None)]
    twice = lifecycle.edit_jobs(once, edits, datetime(2025, 1, 1))
    assert rows(twice, "id", "application_date") == [(1, now), (2, None)]


def test_series_fills_gaps(spark):
    events = spark.createDataFrame([(datetime(2024, 1, 1, 5), 1), (datetime(2024, 1, 3, 23, 59), 1), (datetime(2024, 1, 4), 1)], "ts timestamp, user_id int")
    out = series.daily_series(events, date(2024, 1, 1), date(2024, 1, 3))
    assert rows(out, "day", "count") == [(date(2024, 1, 1), 1), (date(2024, 1, 2), 0), (date(2024, 1, 3), 1)]


def test_salary_overlap_bounds(spark):
    df = spark.createDataFrame([(1, 50, 100), (2, 200, 300)], "id int, salary_min int, salary_max int")
    assert rows(df.filter(salary_overlap(150, 750_000)), "id") == [(2,)]
    assert rows(df.filter(salary_overlap(0, 100)), "id") == [(1,)]


@pytest.fixture(scope="module")
def index(spark):
    docs = spark.createDataFrame([
        (1, "Senior Machine Learning Engineer", "machine learning with python and django"), (2, "Python Developer", "learning machine code, not a phrase"),
        (3, "Développeur Python", "intelligence artificielle"), (4, "Junior engineer", "python, far away from it all is the django thing here")],
        "id long, title string, description string")
    return search.build_index(docs, ("title", "description"))


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_search_kinds(index):
    q = search.query_terms
    assert ids(search.phrase_search(index, q("Machine Learning"))) == [1]
    assert ids(search.near_search(index, "python", "django", 1)) == [1]
    assert ids(search.field_search(index, "title", q("engineers")[0])) == [1, 4]
    assert ids(search.boolean_search(index, every=q("python"), none=q("junior"))) == [1, 2, 3]
    assert ids(search.boolean_search(index, some=q("developpeur"))) == [3]
    assert q("PYTHON Développeur") == q("python developpeur")
    with pytest.raises(ValueError):
        search.boolean_search(index, none=["x"])


def test_ranking_prefers_denser_documents(index):
    hits = search.ranked_search(index, search.index_lengths(index), search.query_terms("machine learning"))
    ranks = {r.doc_id: r.rank for r in hits.collect()}
    assert set(ranks) == {1, 2} and ranks[1] < ranks[2] < 0


def test_html_list_rows(spark):
    cell = "<tr><td>{}</td><td>{}</td><td>{}</td><td>{}</td><td>{}</td></tr>"
    html = cell.format("<a>Acme &amp; Co</a> 🔥", "Engineer", "SF</br>NYC", '<a href="https://x">y</a>', "1d") + cell.format("↳", "Analyst 🛂", "LA", "🔒", "2d")
    out = lists.ingest_job_lists(spark.createDataFrame([(1, html)], "page_id int, html string"))
    assert [tuple(r) for r in out.orderBy("pos").select("company", "role", "locations", "apply_url", "closed", "no_sponsorship").collect()] == [
        ("Acme & Co", "Engineer", ["SF", "NYC"], "https://x", False, False), ("Acme & Co", "Analyst", ["LA"], None, True, True)]


def test_sitemap_default_date(spark):
    companies = spark.createDataFrame([("a",), ("b",)], "alias string")
    vacancies = spark.createDataFrame([("a", date(2024, 3, 1))], "alias string, date date")
    assert rows(sinks.sitemap_rows(companies, vacancies, "h", "go"), "lastmod") == [("2024-03-01",), ("2025-01-01",)]


def test_first_per_key_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(None, None, "a"), (None, 1, "b"), (1, 2, "c"), (1, None, "d"), (2, 5, "e")], "k int, o int, v string")
    first, last = keyed.keep_first(df, ["k"], ["o"]), keyed.keep_last(df, ["k"], ["o"])
    assert sorted(r.v for r in first.collect()) == ["a", "d", "e"]
    assert sorted(r.v for r in last.collect()) == ["b", "c", "e"]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan and "SortAggregate" not in plan


def test_sources_are_told_from_a_few_rows_of_each_task(spark):
    """No task gathers the jobs of a large source: they are reduced before any join."""
    sources = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id long, name string")
    jobs = spark.range(1000).select((F.col("id") % 2 * 2).alias("source_id"))
    kept = lifecycle.drop_empty_sources(sources, jobs)
    assert [tuple(r) for r in kept.collect()] == [(2, "b")]
    assert "Aggregate" in kept._jdf.queryExecution().optimizedPlan().toString()


def test_numbers_join_their_offsets_where_they_are(spark):
    """The rows meet the offsets in the partitions of the window: they are shuffled once, by their range."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = keyed.numbered(spark.createDataFrame([(k, "wide") for k in (5, None, 250, 7)], "k long, text string"), "k", F.lit(0), "id", width=100)
        plan = out._jdf.queryExecution().executedPlan().toString()
        wide = [line for line in plan.splitlines() if "hashpartitioning(coalesce(_range" in line]
        assert not wide, plan
        assert rows(out.fillna(-1), "k", "id") == [(-1, 4), (5, 1), (7, 2), (250, 3)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_upsert_sorts_no_stored_rows_and_keeps_little_of_known_ones(spark, monkeypatch):
    schema = "id long, seq long, content_hash string, first_seen_at timestamp, last_seen_at timestamp, created_at timestamp, updated_at timestamp, is_active boolean, title string"
    early, now = datetime(2020, 1, 1), datetime(2021, 1, 1)
    row = lambda i, h: (i, i, h, early, early, early, early, False, f"title {i}")
    base = spark.createDataFrame([row(1, "a"), row(2, "a"), row(3, None), row(4, "b")], schema)
    batch = spark.createDataFrame([row(9, "a"), row(8, "c"), row(7, "c"), row(6, None), row(5, "d")], schema)
    arrivals, keep = [], lifecycle.kept
    monkeypatch.setattr(lifecycle, "kept", lambda *a, **o: arrivals.append(keep(*a, **o)) or arrivals[-1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lifecycle.upsert_jobs(base, batch, now)
        assert "ShuffledHashJoin" in out._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["id"], r["content_hash"] or "", r["title"], r["is_active"], r["action"]) for r in out.collect()) == [
            (1, "a", "title 1", True, "updated"), (2, "a", "title 2", True, "updated"), (3, "", "title 3", False, "kept"), (4, "b", "title 4", False, "kept"),
            (5, "d", "title 5", True, "inserted"), (6, "", "title 6", True, "inserted"), (7, "c", "title 7", True, "inserted")]
        assert {r["content_hash"]: r["title"] for r in arrivals[0].collect()} == {"a": None, "c": "title 7", None: "title 6", "d": "title 5"}
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "ShuffledHashJoin" not in lifecycle.upsert_jobs(base, batch, now)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
