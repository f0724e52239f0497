"""Benchmark passages in documents: q-gram lemma filtering in diagonal bands, banded alignment to prove them."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .encode import slices
from .frames import numbered, restored
from .words import text_bytes

Q, RATE = 8, 0.1
NARROW = 4  # a band starts at a multiple of 2^b diagonals, b at least this and 2^b over the budget, and is wider by the budget
ITEM_BYTES = 4 << 20  # items searched at once
_FILTER = 22
_ODD = np.uint64(0x9E3779B97F4A7C15)


def folded(text: str) -> str:
    """Lower case, blanks as spaces; as many characters as before."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    for blank in "\t\n\v\f\r":
        low = low.replace(blank, " ")
    return low


def _bytes(text: str) -> bytes:
    """One byte per character; characters beyond Latin-1 may share a byte, which only adds candidates."""
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        wide = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        return np.where(wide < 256, wide, (wide * np.uint32(2654435761) >> np.uint32(24))).astype(np.uint8).tobytes()


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


class Index:
    """The q-grams of benchmark items, with each item's edit budget and the least number of q-grams it must share."""

    def __init__(self, items: list[tuple], q: int = Q, rate: float = RATE) -> None:
        self.ids, self.texts, self.q = [i for i, _ in items], [folded(t or "") for _, t in items], q
        m = np.array([len(t) for t in self.texts], np.int64)
        self.m = m
        self.budget = np.maximum(0, np.minimum((m * rate).astype(np.int64), m // q - 1))  # m + 1 - q (k + 1) stays positive
        self.least = m + 1 - q * (self.budget + 1)
        self.band = np.maximum(NARROW, np.array([int(k).bit_length() for k in self.budget], np.int64))
        self.short = [i for i in range(len(m)) if 0 < m[i] < q]
        grams, owner, place = [], [], []
        for i, text in enumerate(self.texts):
            if m[i] >= q:
                got = self.grams(_bytes(text))
                grams.append(got)
                owner.append(np.full(len(got), i))
                place.append(np.arange(len(got)))
        flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.gram, self.first = np.unique(flat[order], return_index=True)
        self.last = np.append(self.first[1:], len(flat))
        self.owner = np.concatenate(owner)[order] if owner else np.zeros(0, np.int64)
        self.place = np.concatenate(place)[order] if place else np.zeros(0, np.int64)
        self.maybe = np.zeros(1 << _FILTER, bool)
        self.maybe[(self.gram * _ODD) >> np.uint64(64 - _FILTER)] = True

    def grams(self, data: bytes) -> np.ndarray:
        """Each window of q bytes as a number."""
        n = len(data) - self.q + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        view = np.ndarray(n, "<u8", data + bytes(8), strides=(1,))
        return view & np.uint64((1 << 8 * self.q) - 1) if self.q < 8 else view

    def candidates(self, data: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, first diagonal) of the bands in which a text shares enough q-grams with an item."""
        none = (np.zeros(0, np.int64),) * 3
        grams = self.grams(data)
        if not len(grams) or not len(self.gram):
            return none
        at = np.flatnonzero(self.maybe[(grams * _ODD) >> np.uint64(64 - _FILTER)])
        where = np.minimum(np.searchsorted(self.gram, grams[at]), len(self.gram) - 1)
        hit = self.gram[where] == grams[at]
        at, where = at[hit], where[hit]
        text = np.searchsorted(starts, at, "right") - 1
        inside = at + self.q < starts[text + 1]  # the byte between two texts is not theirs
        at, where, text = at[inside], where[inside], text[inside]
        few = np.bincount(text, minlength=len(starts) - 1) >= (self.least[self.m >= self.q].min() if (self.m >= self.q).any() else 1)
        at, where, text = at[few[text]], where[few[text]], text[few[text]]
        n = self.last[where] - self.first[where]
        post = np.repeat(self.first[where] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        item, text = self.owner[post], np.repeat(text, n)
        diagonal = np.repeat(at - starts[text[np.cumsum(n) - n]] if len(n) else at, n) - self.place[post]
        shifted = diagonal + (1 << 40)
        band = shifted >> self.band[item]
        second = (shifted & ((1 << self.band[item]) - 1)) < self.budget[item]  # bands overlap by the budget
        band, item, text = (np.concatenate(x) for x in ((band, band[second] - 1), (item, item[second]), (text, text[second])))
        order = np.lexsort((band, item, text))
        band, item, text = band[order], item[order], text[order]
        new = np.ones(len(band), bool)
        new[1:] = (band[1:] != band[:-1]) | (item[1:] != item[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        enough = np.diff(np.append(first, len(band))) >= self.least[item[first]]
        first = first[enough]
        return text[first], item[first], (band[first] << self.band[item[first]]) - (1 << 40)

    def align(self, items: list[int], regions: list[tuple[np.ndarray, int]]) -> list[list[tuple[int, int, int]]]:
        """(edits, start, end) of each item's places in its text near a diagonal, the best start of every end within the budget.

        A band of cells per pair, all pairs at once.
        """
        patterns, k = [_points(self.texts[i]) for i in items], self.budget[items]
        m, width, n = self.m[items], int((1 << self.band[items]).max()) + 3 * int(k.max()) + 2, len(items)
        wanted, texts = np.full((n, m.max()), -2, np.int64), np.full((n, m.max() + width), -1, np.int64)
        low = np.array([d for _, d in regions]) - k
        for row, (points, _) in enumerate(regions):  # column x of row i is text place low + i + x
            wanted[row, : m[row]] = patterns[row]
            a, b = max(0, low[row]), max(0, min(len(points), low[row] + texts.shape[1]))
            texts[row, a - low[row] : b - low[row]] = points[a:b]
        step, x, away = 1 << 32, np.arange(width), np.int64(1) << 60
        ends = np.array([len(p) for p, _ in regions])[:, None]
        place = low[:, None] + x
        cells = np.where((place >= 0) & (place <= ends), place, away)  # cost above, start below
        edge, out = np.full((n, 1), away), [[] for _ in range(n)]
        for i in range(1, int(m.max()) + 1):
            place += 1
            real = (place >= 0) & (place <= ends)
            up = np.concatenate((cells[:, 1:], edge), axis=1) + step
            across = np.where(place >= 1, cells + np.where(texts[:, i - 1 : i - 1 + width] == wanted[:, i - 1, None], 0, step), away)
            cells = np.minimum.accumulate(np.where(real, np.minimum(up, across), away) - x * step, axis=1) + x * step
            cells = np.where(real, cells, away)
            for row in np.flatnonzero(m == i).tolist():
                near = np.flatnonzero(cells[row] >> 32 <= k[row])
                out[row] = [(int(cells[row, c] >> 32), int(cells[row, c] & (step - 1)), int(place[row, c])) for c in near]
        return out

    def find(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, start, end, edits) of every place within an item's budget, in characters; the best of those that overlap.

        Of overlapping places the one with fewer edits stays, then the one that starts, then the one that ends first. Places are taken
        in that order, and each that overlaps none taken before is one of the result.
        """
        plain = [folded(t.decode("utf-8", "replace")) for t in texts]
        data = b"\0".join(map(_bytes, plain))
        starts = np.cumsum([0, *(len(t) + 1 for t in plain)])
        text, item, diagonal = self.candidates(data, starts)
        bands = list(zip(text.tolist(), item.tolist(), diagonal.tolist(), strict=True))
        same = [self._unchanged(plain[t], i, d) for t, i, d in bands]
        taken = _Places()
        for t, i, at in sorted({(t, i, at) for (t, i, _), places in zip(bands, same, strict=True) for at in places}):
            taken.add(t, i, at, at + int(self.m[i]), 0)
        # Two places of one band overlap if the item is longer than the band: then a place that is taken settles it.
        width = (1 << self.band) + 3 * self.budget
        todo = [band for band, places in zip(bands, same, strict=True)
                if self.m[band[1]] <= width[band[1]] or not any(taken.has(band[0], band[1], at) for at in places)]
        todo.sort(key=lambda r: self.m[r[1]])
        points = {t: _points(plain[t]) for t in {r[0] for r in todo}}
        near = set()
        for at in range(0, len(todo), 128):
            part = todo[at : at + 128]
            for (t, i, _), places in zip(part, self.align([r[1] for r in part], [(points[r[0]], r[2]) for r in part]), strict=True):
                near.update((t, i, edits, a, b) for edits, a, b in places)
        for t, i, edits, a, b in sorted(near):
            taken.add(t, i, a, b, edits)
        for i in self.short:  # shorter than a q-gram: exact places
            for t, words in enumerate(plain):
                at = words.find(self.texts[i])
                while at >= 0:
                    taken.add(t, i, at, at + len(self.texts[i]), 0)
                    at = words.find(self.texts[i], at + len(self.texts[i]))
        return taken.rows()

    def _unchanged(self, text: str, item: int, diagonal: int) -> list[int]:
        """Every start of an item as it is, in the reach of a band."""
        k, m = int(self.budget[item]), int(self.m[item])
        out, end = [], max(0, diagonal + (1 << int(self.band[item])) + 2 * k + m)
        at = text.find(self.texts[item], max(0, diagonal - k), end)
        while at >= 0:
            out.append(at)
            at = text.find(self.texts[item], at + 1, end)
        return out


class _Places:
    """Places by text and item, none of which overlap."""

    def __init__(self) -> None:
        self.held: dict[tuple[int, int], list[tuple[int, int, int]]] = {}

    def add(self, text: int, item: int, start: int, end: int, edits: int) -> None:
        """Takes a place if it overlaps none that is held; two of them meet a place at most on either side."""
        held = self.held.setdefault((text, item), [])
        at = bisect_left(held, (start,))
        if not (at and held[at - 1][1] > start) and not (at < len(held) and held[at][0] < end):
            held.insert(at, (start, end, edits))

    def has(self, text: int, item: int, start: int) -> bool:
        held = self.held.get((text, item), [])
        at = bisect_left(held, (start,))
        return at < len(held) and held[at][0] == start

    def rows(self) -> list[tuple[int, int, int, int, int]]:
        return [(*key, *place) for key, places in sorted(self.held.items()) for place in places]


def _indexes(benchmark: DataFrame, q: int, rate: float, item_bytes: int) -> Iterator[Index]:
    """The benchmark in parts whose size is measured first, so that each is small enough to travel with a task."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(total // item_bytes) + 1
    for part in range(parts):
        rows = benchmark.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) == part) if parts > 1 else benchmark
        items = sorted({(r[0], r[1]) for r in rows.select("item_id", "text").collect()}, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        yield Index(items, q, rate)


def find_passages(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """One row per document and place of a benchmark item: doc_id, item_id, start, end (characters), edits; places of an item do not overlap.

    An item is found where it can be turned into a stretch of the text by at most `rate` edits per character, in lower case. Then the two
    share at least m + 1 - q (k + 1) q-grams on k + 1 neighbouring diagonals, so only bands that do are aligned. Items too short for the
    rate have the largest budget the lemma allows; items under q characters must match exactly.

    Needs `doc_id` and `text` of documents and `item_id` and `text` of the benchmark; other columns are ignored. Null and empty texts
    hold nothing, null and empty items match nothing; repeated rows are reported each, repeated items once; empty tables give no rows.
    """
    ids, items = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = T.StructType([T.StructField("doc_id", ids), T.StructField("item_id", items), *(T.StructField(c, T.LongType()) for c in ("start", "end", "edits"))])

    def scan(index: Index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_schema

            arrow = to_arrow_schema(schema)
            for batch in batches:
                texts = text_bytes(batch.column(1))
                rows = [(part.start + r[0], *r[1:]) for part in slices(texts, 1 << 21) for r in index.find(texts[part])]
                places, numbers = pa.array([r[0] for r in rows], pa.int64()), [[r[i] for r in rows] for i in (2, 3, 4)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(places), pa.array([index.ids[r[1]] for r in rows], arrow.field(1).type),
                                                  *(pa.array(n, pa.int64()) for n in numbers)], schema=arrow)

        return docs.select("doc_id", "text").mapInArrow(run, schema)

    out = None
    for index in _indexes(benchmark, q, rate, item_bytes):
        out = scan(index) if out is None else out.union(scan(index))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The documents in which no benchmark item is found; all columns of the input stay."""
    at, columns, docs = docs.columns.index("text"), docs.columns, numbered(docs)
    for index in _indexes(benchmark, q, rate, item_bytes):
        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = text_bytes(batch.column(at))
                clean = np.ones(len(texts), bool)
                for part in slices(texts, 1 << 21):
                    clean[[part.start + r[0] for r in index.find(texts[part])]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return restored(docs, columns)
