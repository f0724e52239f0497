"""Packing of token sequences: minimum bin slack over the lengths that remain."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import kept
from .encode import DEFAULT_TOKENIZER, encoder, slices
from .words import text_bytes

WINDOW = 2048
RANGE_ROWS = 10_000


def best_fill(counts: dict[int, int], capacity: int, first: int) -> tuple[dict[int, int], int]:
    """Which lengths fill a window best beside one of length `first`, and the sum.

    A bitset holds the sums that the lengths so far can reach; the layers are walked back to the counts used. An exact
    fill ends the search. Without one, the largest reachable power of two is taken, as it needs no padding, else the
    largest sum.
    """
    target = capacity - first
    reach, mask, layers = 1, (1 << (target + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == first), target // length)
        if left <= 0:
            continue
        layers.append((length, reach))
        step = 1
        while left > 0:
            take = min(step, left)
            reach |= reach << (take * length)
            left -= take
            step *= 2
        reach &= mask
        if reach >> target & 1:
            break
    best = reach.bit_length() - 1
    if best < target:
        even = [1 << k for k in range(capacity.bit_length()) if first <= 1 << k < capacity and reach >> ((1 << k) - first) & 1]
        best = max(even) - first if even else best
    used, rest = {first: 1}, best
    for length, before in reversed(layers):
        while not before >> rest & 1:
            rest -= length
            used[length] = used.get(length, 0) + 1
    return used, first + best


def plan(histogram: dict[int, int], capacity: int = WINDOW) -> list[tuple[int, dict[int, int], int]]:
    """Window patterns as (number of windows, copies of each length, sum) that use up the histogram.

    Each round fixes the largest length left, finds its best fill and repeats the pattern while the counts last, so
    the work depends on the number of different lengths and not on the number of documents.
    """
    left, out = {k: n for k, n in histogram.items() if n > 0}, []
    while left:
        used, total = best_fill(left, capacity, max(left))
        windows = min(left[k] // n for k, n in used.items())
        out.append((windows, used, total))
        for k, n in used.items():
            left[k] -= n * windows
            if not left[k]:
                del left[k]
    return out


def _pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer), int(end_id).to_bytes(4, "little")
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for part in slices(texts):
                rows, starts, lengths, sums, totals = [], [], [], [], []
                for row, ids in enumerate(encode.texts(texts[part]), part.start):
                    ids += end
                    for at in range(0, len(ids), 4 * capacity):
                        piece = ids[at : at + 4 * capacity]
                        rows.append(row)
                        starts.append(at // 4)
                        lengths.append(len(piece) // 4)
                        sums.append(zlib.crc32(piece))
                        totals.append(len(ids) // 4)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    ids = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", ids), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens"))])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, end_id: int = 1, capacity: int = WINDOW) -> DataFrame:
    """Every document's tokens in sequences of at most `capacity`, one row per piece.

    A document's ids and then `end_id` are cut at multiples of the capacity. Whole windows fill a sequence each;
    what remains of the documents is packed by minimum bin slack, uncut. Only the counts of the lengths (at
    most `capacity` numbers) reach the driver; pieces are ranked among those of equal length inside
    ranges of bounded size and find their place from the rank.

    Needs `doc_id` and `text`; other columns are ignored. A null or empty text is the end id alone; a null id stays
    null; repeated rows are packed each; an empty table gives no rows.
    """
    pieces = kept(_pieces(docs, tokenizer, end_id, capacity), "pieces")
    ranges = pieces.count() // RANGE_ROWS + 1
    pieces = pieces.withColumn("_range", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(ranges)))
    sizes = pieces.groupBy("length", "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    inside = Window.partitionBy("length", "_range").orderBy("doc_id", "start", "ids_crc32")
    ranked = pieces.withColumn("_rank", F.row_number().over(inside) - 1).join(sizes, ["length", "_range"])
    places: dict[int, list[tuple[int, int, int, int]]] = {}
    taken, sequence = dict.fromkeys(histogram, 0), 0
    for windows, used, _ in plan(histogram, capacity):
        offset = 0
        for length, copies in used.items():
            places.setdefault(length, []).append((taken[length], copies, sequence, offset))
            taken[length] += windows * copies
            offset += length * copies
        sequence += windows

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {k: np.array(v, np.int64) for k, v in places.items()}
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 5))
            where, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length):
                rows, t = np.flatnonzero(length == size), table[int(size)]
                hit = t[np.searchsorted(t[:, 0], rank[rows], "right") - 1]
                window, slot = np.divmod(rank[rows] - hit[:, 0], hit[:, 1])
                where[rows], offset[rows] = hit[:, 2] + window, hit[:, 3] + slot * size
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(where), pa.array(offset)],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    schema = T.StructType([*(pieces.schema[c] for c in columns), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select(*columns, (F.col("_before") + F.col("_rank")).cast("long").alias("_rank")).mapInArrow(place, schema)
