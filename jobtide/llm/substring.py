"""Repeated word sequences: difference-cover anchors find them, whole windows prove them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocks
from .words import Hasher, _powers, mix, text_bytes

WINDOW = 35
PERIOD, COVER = 21, (3, 6, 7, 12, 14)  # every difference modulo 21 is a difference of two members
BLOCK_BYTES = 8 << 20


def covers(period: int, cover: tuple[int, ...]) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


class _Words:
    """The words of a block's texts, hashed, with hashes of all runs of a given width inside one text."""

    def __init__(self, texts: list[bytes]) -> None:
        self.data, self.starts, self.ends, self.hashes, self.first = Hasher().documents(texts)
        self.up, self.down = _powers(len(self.hashes) + 1)
        self.n = np.diff(self.first)
        self.place = np.arange(len(self.hashes)) - np.repeat(self.first[:-1], self.n)
        self.room = np.repeat(self.n, self.n) - self.place  # words from here to the end of the text

    def runs(self, width: int, twist: int = 0) -> np.ndarray:
        """A hash for each start; starts too near to the end of all texts are left out."""
        words = mix(self.hashes ^ np.uint64(twist)) if twist else self.hashes
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * self.up[:-1])))
        return mix((sums[width:] - sums[:-width]) * self.down[: len(sums) - width] + np.uint64(width))


def _split(keys: np.ndarray, extra: list[np.ndarray], buckets: int, rack: int, block: int) -> pa.Table:
    rows = []
    for bucket, at in enumerate(blocks.by_bucket(keys, buckets)):
        if len(at):
            size = np.array([len(at)], "<u4").tobytes()
            rows.append((bucket, block, size + b"".join(np.ascontiguousarray(x[at]).tobytes() for x in (keys, *extra))))
    return blocks.asked(rows, rack)


def _unsplit(payload: bytes, kinds: list[str]) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(payload, "<u4", 1)[0]), 4, []
    for kind in kinds:
        out.append(np.frombuffer(payload, kind, n, at))
        at += out[-1].nbytes
    return out


def _repeated(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the first of equal keys in sorted order, and how many there are of each."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    for key in keys[:1]:
        new[1:] = key[order][1:] != key[order][:-1]
    for key in keys[1:]:
        new[1:] |= key[order][1:] != key[order][:-1]
    at = np.flatnonzero(new)
    return order[at], np.diff(np.concatenate((at, [len(order)])))


def _answer(kinds: list[str], with_keys: bool):
    """Which keys of each payload are held twice, by one block or by two: as bits, or as the keys themselves."""
    def answer(payloads: list[bytes]) -> list[bytes]:
        parts = [_unsplit(p, kinds) for p in payloads]
        sizes = [len(p[0]) for p in parts]
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        order = np.lexsort(columns[-2::-1])
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns[:-1]])
        group = np.cumsum(new) - 1
        times = np.bincount(group, weights=columns[-1][order])
        twice = np.empty(len(order), bool)
        twice[order] = (times >= 2)[group]
        out = []
        for part, hit in zip(parts, np.split(twice, np.cumsum(sizes)[:-1]), strict=True):
            out.append(b"".join(c[hit].tobytes() for c in part[:-1]) if with_keys else np.packbits(hit).tobytes())
        return out

    return answer


def remove_repeats(docs: DataFrame, window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER,
                   block_bytes: int = BLOCK_BYTES, direct: int = blocks.DIRECT) -> DataFrame:
    """Each document without the words of any `window` consecutive words that also start anywhere else.

    Two equal windows lie at some difference of places; the cover holds two places of that difference modulo the
    period, so both windows hold an anchor at the same shift. Anchors (runs of window - period + 1 words at cover
    places only) are counted over all documents; the windows around an anchor that occurs twice are counted in turn
    by 96 bits of hash, and those that occur twice cover what is removed. Counts travel as distinct keys
    per block, so a passage that a third of the documents share costs one key per block. With more than `direct` buckets the exchange
    takes two steps (see `blocks`).

    Needs `doc_id` and `text`; other columns are ignored. Null and blank texts have no words; texts shorter than the
    window stay whole; repeated rows are copies of each other, and both lose what repeats; an
    empty table gives no rows. Returns doc_id, n_words, n_removed and kept_text (words joined by one space).
    """
    if not covers(period, cover) or period > window:
        raise ValueError("the cover must hold every difference modulo the period, and the period must fit the window")
    width = window - period + 1
    dealt, buckets = blocks.blocked(docs.select("doc_id", "text"), "text", block_bytes)
    dealt, rack = dealt.repartition("_block"), blocks.rack_size(buckets, direct)
    anchor_kinds, window_kinds = ["<u8", "u1"], ["<u8", "<u4", "u1"]

    def anchors(words: _Words) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(np.isin(words.place % period, cover) & (words.room >= width) & (np.repeat(words.n, words.n) >= window))
        return at, words.runs(width)[at] if len(at) else np.zeros(0, np.uint64)

    def ask_anchors(key: tuple, table: pa.Table) -> pa.Table:
        _, hashes = anchors(_Words(text_bytes(blocks.rows(table)["text"])))
        keys, times = np.unique(hashes, return_counts=True)
        return _split(keys, [np.minimum(times, 2).astype("u1")], buckets, rack, key[0].as_py())

    def ask_windows(key: tuple, table: pa.Table, got: pa.Table) -> pa.Table:
        if not table.num_rows or not got.num_rows:
            return blocks.asked([])
        words = _Words(text_bytes(blocks.rows(table)["text"]))
        at, hashes = anchors(words)
        keys = np.unique(hashes)
        shared, said = np.zeros(len(keys), bool), blocks.replies(got, rack)
        for bucket, places in enumerate(blocks.by_bucket(keys, buckets)):
            if bucket in said:
                shared[places] = np.unpackbits(np.frombuffer(said[bucket], np.uint8), count=len(places)).astype(bool)
        hit = at[shared[np.searchsorted(keys, hashes)]] if len(at) else at
        mark = np.zeros(len(words.hashes) + 1, np.int32)  # starts from `period - 1` words before an anchor up to it
        np.add.at(mark, hit - np.minimum(words.place[hit], period - 1), 1)
        np.add.at(mark, hit + 1, -1)
        starts = np.flatnonzero((np.cumsum(mark[:-1]) > 0) & (words.room >= window))
        if not len(starts):
            return blocks.asked([])
        full, check = words.runs(window)[starts], words.runs(window, twist=1)[starts].astype("<u4")
        first, times = _repeated(full, check)
        return _split(full[first], [check[first], np.minimum(times, 2).astype("u1")], buckets, rack, key[0].as_py())

    def cut(key: tuple, table: pa.Table, got: pa.Table) -> pa.Table:
        rows = blocks.rows(table)
        words = _Words(text_bytes(rows["text"]))
        gone = np.zeros(len(words.hashes) + 1, np.int32)
        said = [(np.frombuffer(x, "<u8", len(x) // 12), np.frombuffer(x, "<u4", len(x) // 12, len(x) // 12 * 8)) for x in blocks.replies(got, rack).values()]
        twice, checks = (np.concatenate(x) for x in zip(*said, strict=True)) if said else (np.zeros(0, np.uint64),) * 2
        if len(twice):
            order = np.lexsort((checks, twice))
            twice, checks = twice[order], checks[order]
            whole = np.flatnonzero(words.room >= window)
            hashes, proof = words.runs(window)[whole], words.runs(window, twist=1)[whole].astype("<u4")
            at, hit = np.searchsorted(twice, hashes), np.zeros(len(whole), bool)
            for _ in range(int(np.unique(twice, return_counts=True)[1].max())):  # one, unless windows share their first 64 bits
                there = np.minimum(at, len(twice) - 1)
                hit |= (twice[there] == hashes) & (checks[there] == proof) & (at < len(twice))
                at = at + 1
            starts = whole[hit]
            np.add.at(gone, starts, 1)
            np.add.at(gone, starts + window, -1)
        covered = np.cumsum(gone[:-1]) > 0
        removed = np.add.reduceat(np.concatenate((covered, [False])).astype(np.int64), words.first[:-1]) * (words.n > 0) if len(words.n) else words.n
        texts = []
        for i in range(len(words.n)):
            a, b = words.first[i], words.first[i + 1]
            if removed[i]:
                stay = np.flatnonzero(~covered[a:b]) + a
                texts.append(b" ".join([words.data[s:e] for s, e in zip(words.starts[stay].tolist(), words.ends[stay].tolist(), strict=True)]))
            else:
                texts.append(b" ".join(words.data[words.starts[a] : words.ends[b - 1]].split()) if b > a else b"")
        return pa.Table.from_arrays([rows["doc_id"], pa.array(words.n.astype(np.int64)), pa.array(removed.astype(np.int64)),
                                     pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    by_block = dealt.groupBy("_block")
    first = blocks.answers(by_block.applyInArrow(ask_anchors, blocks.ASK), _answer(anchor_kinds, False), buckets, rack)
    asked = by_block.cogroup(first.groupBy("_block")).applyInArrow(ask_windows, blocks.ASK)
    second = blocks.answers(asked, _answer(window_kinds, True), buckets, rack)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept_text", T.StringType())])
    return by_block.cogroup(second.groupBy("_block")).applyInArrow(cut, schema)


def kept_digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
