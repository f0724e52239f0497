import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from jobtide.llm import packing, tokens
from jobtide.llm.encode import DEFAULT_TOKENIZER, Encoder


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(public_tokenizers.path(DEFAULT_TOKENIZER))


ENCODERS: list[Encoder] = []
ODD = ["A.b.", "don't. I'll, x", "Ünï., ὈΔΟΣ. Σ", "a..b ... ,, . .,", "<|endoftext|>. x<|startoftext|>y", "İstanbul. é́ é.  b.", "1.2.3. a1. 5,", "\x00a. ﻿b", "中文。a. 🙂. ", "a. b ,c", "x's. 's, '.s"]


def test_words_give_the_ids_of_whole_texts(whole, rows):
    texts = ODD + [r[1] or "" for r in rows]
    encode = Encoder(DEFAULT_TOKENIZER, memory=50)
    for text in texts:
        ids = np.frombuffer(encode.texts([text.encode()])[0], "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB.,' 's1é́<|>\n ß", max_size=30))
def test_any_text(text):
    encode = Encoder(DEFAULT_TOKENIZER) if not ENCODERS else ENCODERS[0]
    ENCODERS[:] = [encode]
    whole = encode.tokenizer
    encode.known.clear()
    assert np.frombuffer(encode.texts([text.encode()])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=12))
def test_plan_uses_every_length_once(histogram):
    used = Counter()
    for windows, copies, total in packing.plan(histogram, 64):
        assert total == sum(k * n for k, n in copies.items()) <= 64
        for k, n in copies.items():
            used[k] += n * windows
    assert dict(used) == histogram


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 3), min_size=1, max_size=5))
def test_fill_is_the_closest_to_capacity(counts):
    first = max(counts)
    used, total = packing.best_fill(counts, 33, first)
    sums = {first}
    for k, n in counts.items():
        sums |= {s + k * c for s in sums for c in range(n - (k == first) + 1)}
    best = max(s for s in sums if s <= 33)
    powers = [s for s in sums if s in (1, 2, 4, 8, 16, 32)]
    assert total == (33 if best == 33 else max(powers, default=best)) == sum(k * n for k, n in used.items())


def test_pieces_hold_every_id_once(docs, rows, whole):
    found = defaultdict(list)
    sequences = defaultdict(list)
    for r in packing.pack(docs).collect():
        found[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    expected = defaultdict(list)
    for doc_id, text, *_ in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        expected[doc_id] += [(a, len(p := ids[a : a + 2048]), zlib.crc32(np.array(p, "<u4").tobytes()), len(ids)) for a in range(0, len(ids), 2048)]
    assert {k: sorted(v) for k, v in expected.items()} == {k: sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in v) for k, v in found.items()}
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(sequences) == list(range(len(sequences)))


def test_little_padding(docs, rows):
    sums = [r[0] for r in packing.pack(docs).groupBy("sequence_id").sum("length").select("sum(length)").collect()]
    assert sum(2048 - s for s in sums if s & (s - 1)) <= 2048


def test_empty_tables(no_docs):
    assert packing.pack(no_docs).collect() == []
    assert tokens.suffix_sums(tokens.length_histogram(no_docs)).collect() == []


def test_token_counts(docs, rows, whole):
    lengths = [len(whole.encode(t or "", add_special_tokens=False).ids) for _, t, *_ in rows]
    histogram = tokens.length_histogram(docs).cache()
    sums = tokens.suffix_sums(histogram)
    got = {r["tokens"]: r for r in sums.collect()}
    assert sorted(got) == sorted(set(lengths))
    for n, r in got.items():
        assert r["n_docs"] == lengths.count(n) and r["n_tokens"] == n * lengths.count(n)
        assert r["docs_from"] == sum(x >= n for x in lengths) and r["tokens_from"] == sum(x for x in lengths if x >= n)
        assert r["docs_to"] == sum(x <= n for x in lengths) and r["tokens_to"] == sum(x for x in lengths if x <= n)
        assert r["truncated_total"] == sum(min(x, n) for x in lengths)
    limits = [0, 1, 7, 128, 10**6]
    assert {r[0]: r[1] for r in tokens.truncated_totals(histogram, limits).collect()} == {k: sum(min(x, k) for x in lengths) for k in limits}
    assert {r[0]: r[1] for r in tokens.quantiles(sums, [0.5, 1.0]).collect()} == {0.5: sorted(lengths)[-(-len(lengths) // 2) - 1], 1.0: max(lengths)}
