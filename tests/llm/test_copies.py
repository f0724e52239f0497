import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash

from jobtide.llm import blocks, simhash, substring
from jobtide.llm.components import components
from jobtide.llm.words import Hasher, xxh64_spans


def test_word_hashes_follow_the_words():
    texts = [b"", b" ", b"a b  c\td", "né né".encode(), b"x" * 200_000 + b" y", b"a b"]
    data, starts, ends, hashes, first = Hasher().documents(texts)
    words = [w for t in texts for w in t.split()]
    assert [data[a:b] for a, b in zip(starts, ends)] == words
    assert len(set(zip(hashes.tolist(), words))) == len(set(words)) == len(set(hashes.tolist()))
    assert np.diff(first).tolist() == [len(t.split()) for t in texts]


def test_xxh64_of_spans():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(3000))
    starts = np.array([rng.randrange(2900) for _ in range(500)])
    ends = starts + np.array([rng.randrange(0, 80) for _ in range(500)])
    assert xxh64_spans(data, starts, ends).tolist() == [xxhash.xxh64_intdigest(data[a:b], 42) for a, b in zip(starts, ends)]


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, distance=2):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if bin(a ^ b).count("1") <= distance:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_fingerprints_and_components(docs, rows):
    prints = [fingerprint(r[1]) for r in rows]
    root = linked(set(prints))
    least = {}
    for (doc_id, *_), p in zip(rows, prints):
        if doc_id is not None:
            least[root[p]] = min(doc_id, least.get(root[p], doc_id))
    expected = Counter((r[0], p, least.get(root[p])) for r, p in zip(rows, prints))
    got = Counter((r[0], r[1] % (1 << 64), r[2]) for r in simhash.near_duplicates(docs).collect())
    assert got == expected


def test_one_row_of_each_component_stays(docs, rows):
    got = simhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    kept = got.collect()
    root = linked({fingerprint(r[1]) for r in rows})
    assert len(kept) == len(set(root.values()))
    named = {root[fingerprint(r["text"])]: r["doc_id"] for r in kept}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            assert named[root[fingerprint(text)]] <= doc_id


def links_of(spark, prints, distance):
    rows = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fingerprint long")
    return {frozenset((a % (1 << 64), b % (1 << 64))) for a, b in simhash._variant_links(rows, distance).collect()}


def test_every_link_is_found_in_crowded_keys(spark):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = {centre}
    for _ in range(1500):  # many neighbours of one fingerprint: keys go to the second level
        p = centre
        for _ in range(rng.randint(1, 4)):
            p ^= 1 << rng.randrange(64)
        prints.add(p)
    prints |= {centre ^ (x << 40) for x in range(400)} | {rng.getrandbits(64) for _ in range(200)}
    prints = list(prints)
    array = np.array(prints, np.uint64)
    for distance in (2, 3):
        near = np.bitwise_count(array[:, None] ^ array[None, :]) <= distance
        expected = {frozenset((prints[i], prints[j])) for i, j in zip(*np.nonzero(near)) if i < j}
        assert links_of(spark, prints, distance) == expected


def test_runs_longer_than_a_batch():
    keys = np.array([1] * 3 + [2] * 1000 + [3] * 2 + [4] * 400, np.int64)
    prints = np.arange(len(keys))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 150]), pa.array(prints[i : i + 150])], names=["key", "f"]) for i in range(0, len(keys), 150)]
    seen = [(k, p) for ks, ps, _ in simhash._groups(iter(batches)) for k, p in zip(ks.tolist(), ps.tolist())]
    assert seen == list(zip(keys.tolist(), prints.tolist()))


def test_crowded_keys_that_end_with_a_batch():
    for sizes in ([200, 150, 3], [200, 200, 200], [5, 395, 2], [150]):
        keys = np.repeat(np.arange(1, len(sizes) + 1), sizes)
        prints = np.concatenate([np.arange(n) for n in sizes])
        for rows in (50, 150, 200, 400):
            batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + rows]), pa.array(prints[i : i + rows])], names=["key", "f"]) for i in range(0, len(keys), rows)]
            links = {(a, b) for batch in simhash._deep_links(iter(batches), 2) for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist())}
            near = {(a, b) for n in sizes for a in range(n) for b in range(a + 1, n) if (a ^ b).bit_count() <= 2}
            assert {(min(x), max(x)) for x in links} == near


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(-5, 300), (300, -9), (300, 300)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, -5: -9, 300: -9, -9: -9}


def kept_words(rows, width):
    words = [(t or "").encode().split() for _, t, *_ in rows]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = Counter()
    for (doc_id, *_), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out[doc_id, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()] += 1
    return out


def test_repeated_windows_go(docs, rows):
    for block_bytes, direct in ((1 << 30, 9), (2000, 9999), (2000, 9)):  # one block; many; many by racks
        got = substring.kept_digest(substring.remove_repeats(docs, block_bytes=block_bytes, direct=direct)).collect()
        assert Counter(map(tuple, got)) == kept_words(rows, 35)


def test_overlaps_inside_one_text(spark):
    text = " ".join(["a b c"] * 40 + ["d"] + ["e"] * 36)
    rows = [(1, text), (2, "x y z"), (3, " ".join(f"v{i}" for i in range(34)))]
    got = substring.kept_digest(substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert Counter(map(tuple, got)) == kept_words(rows, 35)


def test_windows_are_proved_by_all_their_bits():
    """Keys of equal first 64 bits and other 32: only those held twice in whole are said to be."""
    part = lambda keys, checks, times: substring._split(np.array(keys, np.uint64), [np.array(checks, "<u4"), np.array(times, "u1")], 1, 1, 0)["payload"][0].as_py()
    replies = substring._answer(["<u8", "<u4", "u1"], True)([part([7, 7, 9], [1, 2, 1], [1, 1, 2]), part([7, 8], [2, 1], [1, 1])])
    read = lambda x: list(zip(np.frombuffer(x, "<u8", len(x) // 12).tolist(), np.frombuffer(x, "<u4", len(x) // 12, len(x) // 12 * 8).tolist()))
    assert [read(x) for x in replies] == [[(7, 2), (9, 1)], [(7, 2)]]


def test_bundles():
    rows = [(b, 5, bytes([b] * b)) for b in range(10)]
    table = blocks.asked(rows, 4)
    assert table["_bucket"].to_pylist() == [0, 1, 2]
    assert [(k, x) for p in table["payload"].to_pylist() for k, x in blocks._unbundle(p)] == [(r[0], r[2]) for r in rows]
    assert blocks.asked([], 4).num_rows == 0 and blocks._unbundle(blocks._bundle([])) == []
    assert blocks.rack_size(1024) == 1 and blocks.rack_size(1 << 20) == 1 << 10


def test_empty_tables(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.drop_near_duplicates(no_docs).collect() == []
    assert substring.remove_repeats(no_docs).collect() == []
