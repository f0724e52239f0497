import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobtide.llm import bpe, merkle, periodic
from jobtide.llm.bpe import ForcedEncoder
from jobtide.llm.encode import DEFAULT_TOKENIZER

BLANKS = b" \t\n\r\x0b\x0c"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# Periodic runs


def all_runs(words):
    """Every period, every stretch, by comparing words."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        at = 0
        while at < n - q:
            end = at
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if end > at and length >= max(6, 4 * q) and not any(all(words[k] == words[k + d] for k in range(at, at + length - d)) for d in range(1, q)):
                out.append((at, length, q))
            at = end + 1
    return sorted(out)


def collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=30), st.integers(1, 6)), max_size=5), st.integers(0, 9))
def test_runs_of_repeated_pieces(pieces, cut):
    ids = np.array([x for piece, times in pieces for x in piece * times][cut:], np.int64)
    assert periodic.runs_of(ids, len(ids)) == all_runs(ids.tolist())


def test_runs_of_every_period():
    rng = random.Random(3)
    for q in range(1, 150):
        period = [rng.randrange(4) for _ in range(q)]
        words = [9, *(period * 5)[: 4 * q + rng.randrange(q)], 8, 7] if q > 1 else [9, 5, 5, 5, 5, 5, 5]
        assert periodic.runs_of(np.array(words), len(words)) == all_runs(words)


def repeats(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_documents_with_runs(spark, rows):
    rng = random.Random(5)
    more = [(1000 + i, " ".join(rng.choice("abcde") for _ in range(rng.randrange(300)))) for i in range(120)]
    more += [(2000, "x " * 3000), (2001, "a b c d e f g h i j k l m " * 40 + "z"), (2001, "a b c d e f g h i j k l m " * 40 + "z"), (2002, "a a a a a"), (2003, "a a a a a a")]
    every = [(r[0], r[1]) for r in rows if len(r[1] or "") < 40_000] + more
    docs = spark.createDataFrame(every, "doc_id long, text string").withColumns({"runs": F.lit(1), "strongest": F.lit(1), "_c0": F.lit(1)})
    docs = docs.select("doc_id", periodic.with_repeats(F.col("doc_id"), F.col("text")).alias("text"), "runs", "strongest", "_c0")
    found = periodic.digest(periodic.find_runs(docs.repartition(3))).collect()
    expected = []
    for doc_id, text in every:
        words = repeats(doc_id, text)
        runs = all_runs(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        expected.append((doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs))))
    order = lambda r: str(tuple(r))
    assert sorted((tuple(r) for r in found), key=order) == sorted(expected, key=order)
    assert any(r[1] > 1 for r in expected) and any(r[4] and r[4] > 16 for r in expected)


def test_one_long_run_among_long_texts(spark):
    rng = random.Random(6)
    period = [f"w{rng.randrange(50)}" for _ in range(5003)]
    text = " ".join([f"u{i}" for i in range(7000)] + period * 4 + ["end"] * 40)
    row = periodic.find_runs(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(7000, 20012, 5003), (27012, 40, 1)]
    assert tuple(row["strongest"]) == (27012, 40, 1) and row["n_words"] == 27052


def test_no_documents_no_runs(no_docs):
    assert periodic.digest(periodic.find_runs(no_docs)).collect() == []


# BPE


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(public_tokenizers.path(DEFAULT_TOKENIZER))


@pytest.fixture(scope="module")
def forced():
    return ForcedEncoder(DEFAULT_TOKENIZER, memory=300)


ODD = ["A.b.", "don't. I'LL, 'say !'s ''s x", "Ünï., ὈΔΟΣ. Σ J̌ K", "qzxj xqqz jjvvq", "<|endoftext|>. x<|startoftext|>y<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endof text|>",
       "İstanbul. é́ é.  b.", "1.2.3. a1. 5, 12²½", "\x00a. ﻿b\x1cc\x85d e　f", "中文。a. 🙂👩‍👩‍👧. ", "</w> a</w>b", "", " \t\n\x0b\x0c\r "]


def test_no_token_spans_a_cut(whole, forced):
    tokens = [t.removesuffix("</w>") for t in whole.get_vocab(with_added_tokens=False)]
    assert [p for p in forced.cuts.fragments([t for t in tokens if t]) if len(p) > 1] == []
    assert forced.cuts.fragments(["qzxj", "a", "the"]) == [["q", "zxj"], ["a"], ["the"]] and forced.patterned


def test_byte_letters(forced):
    from tokenizers import pre_tokenizers

    assert sorted(bpe.byte_letters()) == sorted(pre_tokenizers.ByteLevel.alphabet())
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    for text in ("".join(map(chr, range(33, 127))), "é ĀɏΩ日🙂\x01\x7f\xad"):
        assert "".join(bpe.byte_letters()[b] for b in text.encode()) == "".join(w for w, _ in level.pre_tokenize_str(text))


def test_plain_words_are_told_as_the_file_says(forced):
    every = [chr(c) for c in range(33, 592)]
    texts = [a + b for a in every for b in ("x", "'s", "7", "_", "é", ".")] + [b + a for a in every for b in ("x", "'", "7", "_", "²")]
    for text in texts:
        assert forced._told(text) == [w for w, _ in forced.split(forced.normalise(text))]


def test_fragments_give_the_ids_of_whole_texts(whole, forced, rows):
    texts = ODD + [r[1] or "" for r in rows]
    got = forced.texts([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=30), st.text(alphabet="aB.,' 's1é́<|>\n ßqzxjv ", max_size=40)))
def test_any_text(whole, forced, text):
    forced.chunks.clear()
    assert np.frombuffer(forced.texts([text.encode("utf-8", "replace")])[0], "<u4").tolist() == whole.encode(text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids


def test_encoded_and_decoded_documents(docs, rows, whole, spark):
    extra = spark.createDataFrame([(500 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    found = bpe.decode(bpe.encode(docs.select("doc_id", "text", "_c0").unionByName(extra, allowMissingColumns=True))).collect()
    expected = []
    for doc_id, text in [(r[0], r[1]) for r in rows] + [(500 + i, t) for i, t in enumerate(ODD)]:
        ids = whole.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, len(ids), np.array(ids, "<u4").tobytes(), whole.decode(ids, skip_special_tokens=False)))
    assert sorted(((r[0], r[1], bytes(r[2]), r[3]) for r in found), key=str) == sorted(expected, key=str)


def test_no_documents_no_ids(no_docs):
    assert bpe.decode(bpe.encode(no_docs)).collect() == []


# Merkle manifest


def leaf_of(row):
    said = ("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row)
    return sha("".join(said))


def tree(nodes):
    """The root, and for each node the siblings of each level as (before, after)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            first = place - place % 8
            paths[k].append((nodes[first:place], nodes[place + 1 : first + 8]))
            at[k] = place // 8
        nodes = [sha("".join(nodes[a : a + 8])) for a in range(0, len(nodes), 8)]
    return nodes[0], paths


def expected_manifest(rows, shown):
    """rows: (key, group, leaf) of all documents."""
    order = lambda x: (x is not None, (x.encode() if isinstance(x, str) else x) or b"")
    groups = sorted({r[1] for r in rows}, key=order)
    inside = {g: sorted((r for r in rows if r[1] == g), key=lambda r: (r[0] is not None, r[0] or 0, r[2])) for g in groups}
    trees = {g: tree([r[2] for r in inside[g]]) for g in groups}
    root, above = tree([trees[g][0] for g in groups])
    out = []
    for g, upper in zip(groups, above, strict=True):
        for row, lower in zip(inside[g], trees[g][1], strict=True):
            node = shown(row)
            for before, after in lower + upper:
                node = sha("".join(before) + node + "".join(after))
            proof = sha("".join("".join(b) + "".join(a) for b, a in lower + upper))
            out.append((row[0], row[2], trees[g][0], root, proof, node, node == root))
    return out


def found_manifest(docs, shown, levels):
    found = merkle.checked(merkle.manifest(docs, F.col("lang"), F.col("doc_id"), F.col("h"), shown, levels))
    return sorted((tuple(r) for r in found.select("key", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")), "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize(("levels", "sizes"), [
    (0, {"a": 1}), (0, {f"g{i}": 1 + i % 3 for i in range(70)}), (1, {"a": 9, None: 1, "b": 600}), (4, {"a": 9, None: 1, "b": 600}), (1, {"z": 64, "é": 65, "": 513})])
def test_proofs_by_hand(spark, levels, sizes):
    rows = [(i * 7 % 1009, g, sha(f"{g}{i}")) for g, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, h string")
    wrong = F.when(F.col("doc_id") % 3 == 0, F.sha2(F.lit("other"), 256))
    assert found_manifest(docs, wrong, levels) == sorted(expected_manifest(rows, lambda r: sha("other") if r[0] % 3 == 0 else r[2]), key=str)


def test_manifest_of_odd_rows(docs, rows):
    leaves = [(r[0], r[2], leaf_of((r[0], r[3], r[2], r[4], r[1]))) for r in rows]
    digest = merkle.leaf(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    clashing = docs.withColumns({c: F.lit(1) for c in ("tree", "leaf", "key", "group", "_n", "_at", "proof")})
    found = merkle.checked(merkle.manifest(clashing, F.col("lang"), F.col("doc_id"), digest)).select(
        "key", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")), "folded_root", "verified").collect()
    assert sorted((tuple(r) for r in found), key=str) == sorted(expected_manifest(leaves, lambda r: r[2]), key=str)
    assert all(r["verified"] for r in found)


def test_manifest_of_nothing(no_docs):
    assert merkle.checked(merkle.manifest(no_docs, F.col("lang"), F.col("doc_id"), merkle.leaf(F.col("doc_id")))).collect() == []
