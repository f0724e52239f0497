import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobtide.llm import ngrams
from jobtide.llm.eliasfano import EliasFano


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**44), max_size=300), st.lists(st.integers(0, 2**45), max_size=40), st.sampled_from([1, 1 << 20, 1 << 43]))
def test_elias_fano_against_sorted_arrays(values, asked, spread):
    values = np.sort(np.array([v // spread for v in values], np.uint64))
    stored = EliasFano.of(values, 45)
    assert stored.get(np.arange(len(values))).tolist() == values.tolist()
    wanted = np.array([*asked, *values.tolist()], np.uint64)
    assert stored.successor(wanted).tolist() == np.searchsorted(values, wanted).tolist()


def brute(rows, order, prior):
    """Scores by the same recursion over plain dictionaries."""
    texts = [(t or "").encode().lower().split() + [None] for _, t, *_ in rows]
    train = [not held for _, _, held in rows]
    counts = [Counter() for _ in range(order + 1)]
    for words, use in zip(texts, train):
        if use:
            for n in range(1, order + 1):
                for i in range(len(words)):
                    if i >= n - 2:
                        counts[n][tuple(([None] + words)[max(0, i + 2 - n) : i + 2])] += 1
    total, different = sum(counts[1].values()), len(counts[1])
    ends = counts[1][None,] if (None,) in counts[1] else 0
    out = []
    for words in texts:
        base = score = 0.0
        for i, w in enumerate(words):
            p = (counts[1][w,] + 0.1) / (total + 0.1 * (different + 1))
            base += math.log10(p)
            for n in range(2, order + 1):
                if i < n - 2:
                    break
                gram = tuple(([None] + words)[i + 2 - n : i + 2])
                context = ends if gram[:-1] == (None,) else counts[n - 1][gram[:-1]]
                p = (counts[n][gram] + prior * p) / (context + prior)
            score += math.log10(p)
        out.append((len(words), sum(counts[1][w,] > 0 for w in words), total, base, score))
    return out


@pytest.mark.parametrize(("order", "block_bytes", "direct"), [(1, 1 << 20, 9), (2, 1 << 20, 9), (2, 1500, 9999), (3, 1 << 20, 9), (3, 3000, 9999), (3, 5000, 9)])
def test_scores(docs, rows, order, block_bytes, direct):
    use = [(r[0], r[1], r[0] is not None and r[0] % 3 == 0) for r in rows]
    expected = sorted((str(r[0]), h, *b) for r, h, b in zip(rows, (u[2] for u in use), brute(use, order, 8.0)))
    got = sorted((str(r[0]), *r[1:]) for r in ngrams.score(docs, F.col("doc_id") % 3 == 0, order, block_bytes=block_bytes, direct=direct).collect())
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    for g, e in zip(got, expected):
        assert g[5] == pytest.approx(e[5], rel=1e-9)
        assert g[6] == pytest.approx(e[6], rel=0.02)  # quantised


def test_frequent_contexts_are_dealt_over_buckets(spark):
    """Small blocks make many buckets, so that most words are too frequent for one."""
    words = "the the the the of a b c d e f".split()
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 30))), i % 3 == 0) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    for block_bytes in (200, 1 << 20):
        got = sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in ngrams.score(docs, F.col("doc_id") % 3 == 0, 3, block_bytes=block_bytes).collect())
        for g, (i, e) in zip(got, enumerate(brute(rows, 3, 8.0))):
            assert g[:4] == (i, *e[:3]) and g[4] == pytest.approx(e[3], rel=1e-9) and g[5] == pytest.approx(e[4], rel=0.02)


def test_rare_words_after_a_hot_context(tmp_path):
    counts = np.array([1, 2, 3, 50, 10**5, 10**8], np.int64)
    for seen in (10**8, 25 * 10**7, 10**12):
        same = np.full(len(counts), 7, np.uint64)
        trie = ngrams.Trie(same, 0 * same, np.arange(len(counts), dtype=np.uint64), counts, 8.0, 20, str(tmp_path), {7: seen})
        root = trie.root(np.full(len(counts) + 1, 7, np.uint64))
        codes = trie.after.code(trie.after.find(root, np.arange(len(counts) + 1, dtype=np.uint64)))
        assert codes[-1] == ngrams.LACKING and ngrams.unquantised(codes)[-1] == 0
        assert ngrams.unquantised(codes[:-1]) == pytest.approx(counts / (seen + 8.0), rel=0.04)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6), st.integers(0, 6), st.integers(1, 5)), max_size=80), st.lists(st.tuples(*[st.integers(0, 8)] * 3), max_size=60))
def test_trie_against_dictionaries(tmp_path_factory, taught, asked):
    c = Counter()
    for *gram, n in taught:
        c[tuple(gram)] += n
    rows = sorted(c)
    columns = [np.array([g[i] for g in rows], np.uint64) for i in range(3)]
    trie = ngrams.Trie(*columns, np.array([c[g] for g in rows], np.int64), 8.0, 5, str(tmp_path_factory.mktemp("trie")))
    asked = sorted({*asked, *rows[::2]})
    grams = ngrams.Grams(*[np.array([g[i] for g in asked], np.uint64) for i in range(3)], np.ones(len(asked), np.int64))
    again, end = ngrams.Grams.unpack(grams.pack())
    assert all((getattr(grams, x) == getattr(again, x)).all() for x in ("last", "before", "word", "count")) and end == len(grams.pack())
    if not asked:  # what has no grams travels as nothing
        assert ngrams._look_up(trie, again, 0) == b""
        return
    (longer, gram, pair), _ = ngrams._read_planes(ngrams._look_up(trie, again, 0), 0, "<u2", "<u2", "<u2")
    held = lambda test: sum(n for g, n in c.items() if test(g))
    nodes = sorted({g[:2] for g in asked})
    near = lambda codes, values: ngrams.unquantised(codes).tolist() == pytest.approx(values, rel=0.04)
    assert near(longer, [8 / (held(lambda g: g[:2] == x) + 8) if held(lambda g: g[:2] == x) else 0 for x in nodes])
    assert near(gram, [c[g] / (held(lambda x: x[:2] == g[:2]) + 8) if c[g] else 0 for g in asked])
    pairs = sorted({(g[0], g[2]) for g in asked})
    assert near(pair, [held(lambda g: (g[0], g[2]) == x) / (held(lambda g: g[0] == x[0]) + 8) for x in pairs])


def test_production_scores_two_words_of_context(docs, rows):
    use = [(r[0], r[1], False) for r in rows]
    got = sorted((str(r[0]), *r[2:]) for r in ngrams.score(docs, F.lit(False)).collect())
    for g, e in zip(got, sorted((str(r[0]), *b) for r, b in zip(rows, brute(use, 3, 8.0)))):
        assert g[:4] == e[:4] and g[5] == pytest.approx(e[5], rel=0.02)


def test_empty_and_untrained(no_docs, docs):
    assert ngrams.score(no_docs, F.lit(False)).collect() == []
    got = ngrams.score(docs, F.lit(True)).collect()
    assert {r["train_tokens"] for r in got} == {0} and {r["n_known"] for r in got} == {0}


def test_blocks_without_words(spark):
    blank = spark.createDataFrame([(i, " " if i % 2 else None) for i in range(6)], "doc_id long, text string")
    for order in (1, 2, 3):
        got = ngrams.score(blank, F.lit(False), order, block_bytes=1).collect()
        assert len(got) == 6 and {(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got} == {(1, 1, 6)}
        assert len({r["score"] for r in got}) == 1


def test_sorted_hashes_travel_as_distances():
    hashes = np.sort(np.random.default_rng(3).integers(0, 1 << 63, 50_000, dtype=np.uint64) * np.uint64(2))
    assert (ngrams._from_steps(ngrams._steps(hashes)) == hashes).all() and len(ngrams._from_steps(ngrams._steps(hashes[:0]))) == 0
    assert len(ngrams._planes(ngrams._steps(hashes))) < 0.97 * len(ngrams._planes(hashes))


@pytest.mark.parametrize("step", [1, 7, 5000])
def test_numbers_near_each_other_and_far_apart(step):
    """Many places are unpacked together, a few are sought one by one."""
    rng = np.random.default_rng(4)
    values = np.sort(np.concatenate([rng.integers(0, 1 << 40, 70_000), rng.integers(0, 300, 20_000)]).astype(np.uint64))
    stored = EliasFano.of(values, 40)
    places = rng.permutation(len(values))[::step]
    wanted = np.concatenate([values[places], values[places] + np.uint64(1)])
    found, same = stored.seek(wanted)
    assert (stored.get(places) == values[places]).all()
    assert (found == np.searchsorted(values, wanted)).all() and (same == np.isin(wanted, values)).all()


@pytest.mark.parametrize("kind", [0, 1, 2])
def test_a_bucket_seeks_the_grams_of_several_blocks_once(kind, tmp_path, monkeypatch):
    rng = np.random.default_rng(5)
    every = sorted({tuple(g) for g in rng.integers(0, [4, 6 if kind < 2 else 1, 9], (300, 3)).tolist()})
    total, questions = Counter(), []
    for _ in range(12):
        mine = [g for g in every if rng.random() < 0.8]
        counts = rng.integers(0, 3, len(mine))
        total.update(dict(zip(mine, counts.tolist())))
        questions.append(ngrams.Grams(*[np.array([g[i] for g in mine], np.uint64) for i in range(3)], counts))
    seen = {w: 100 + w for w in range(4)}

    def payload(grams):
        pieces = [ngrams.NO_GRAMS.pack()] * 3
        pieces[kind] = grams.pack()
        return b"".join(pieces) + (ngrams._planes(np.array([seen[w] for w in np.unique(grams.last).tolist()], "<i8")) if kind == 2 else b"")

    sought, find = [], ngrams.Children.find
    monkeypatch.setattr(ngrams.Children, "find", lambda self, parents, words: (sought.append(len(words)), find(self, parents, words))[1])
    replies = ngrams._answer_grams(8.0, 5)([payload(q) for q in questions])
    assert sum(sought) <= 3 * len(every)  # contexts, grams and pairs
    taught = sorted(g for g, n in total.items() if n)
    trie = ngrams.Trie(*[np.array([g[i] for g in taught], np.uint64) for i in range(3)], np.array([total[g] for g in taught], np.int64), 8.0, 5, str(tmp_path), seen if kind == 2 else None)
    assert replies == [ngrams._look_up(trie, q, kind) for q in questions]
