"""SimHash near-duplicates: deletion-variant signatures, equality join, verification, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import kept
from .components import components
from .encode import slices
from .words import text_bytes, xxh64_spans

SHINGLE, DISTANCE = 3, 2
SMALL = 128
_LANES = np.uint64(0x0101010101010101)


def fingerprints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each text: bit b is set where over half of the shingle hashes have it."""
    data = b"\n".join(b" ".join(t.lower().split()) for t in texts)
    raw = np.frombuffer(data, np.uint8)
    cuts = np.flatnonzero((raw == 32) | (raw == 10))
    starts, ends = np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(data)]))
    owner = np.cumsum(np.concatenate(([0], raw[cuts] == 10)))
    real = ends > starts
    starts, ends, owner = starts[real], ends[real], owner[real]
    n = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(n) - n
    place, last = np.arange(len(starts)), (first + n - 1)[owner]
    use = np.flatnonzero((place + shingle - 1 <= last) | (place == first[owner]))
    hashes = xxh64_spans(data, starts[use], ends[np.minimum(use + shingle - 1, last[use])])
    m = np.bincount(owner[use], minlength=len(texts))
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(m)
    if not len(some):
        return out
    begin = (np.cumsum(m) - m)[some]
    parts = -(-m[some] // 255)  # byte counters hold 255 ones
    doc_part = np.cumsum(parts) - parts
    at = np.repeat(begin - 255 * doc_part, parts) + 255 * np.arange(parts.sum())
    for low in range(8):  # eight bits at a time, one in each byte
        sums = np.add.reduceat((hashes >> np.uint64(low)) & _LANES, at).view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(sums.astype(np.int64), doc_part, axis=0)
        for byte in range(8):
            out[some] |= (2 * counts[:, byte] > m[some]).astype(np.uint64) << np.uint64(8 * byte + low)
    return out


def fingerprint_rows(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows of a table with `text` and a `fingerprint` (long) at the end."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(at))
            found = [fingerprints(texts[part], shingle) for part in slices(texts, 1 << 20)]
            prints = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints.view(np.int64))], names=[*batch.schema.names, "fingerprint"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("fingerprint", T.LongType())]))


def _pairs_by_shift(keys: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of equal key in sorted order, by distance in that order."""
    for shift in range(1, len(keys)):
        same = np.flatnonzero(keys[shift:] == keys[:-shift])
        if not len(same):
            return
        yield prints[same], prints[same + shift], keys[same]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Runs of whole keys of sorted (key, fingerprint) rows, and parts of keys that are longer than a batch."""
    keys, prints, long = np.zeros(0, np.uint64), np.zeros(0, np.uint64), None
    for batch in batches:
        keys = np.concatenate((keys, batch.column(0).to_numpy().view(np.uint64)))
        prints = np.concatenate((prints, batch.column(1).to_numpy().view(np.uint64)))
        if not len(keys):
            continue
        if long is not None:
            end = np.searchsorted(keys, long, "right")
            yield keys[:end], prints[:end], True
            keys, prints = keys[end:], prints[end:]
            if not len(keys):
                continue
            long = None
        end = np.searchsorted(keys, keys[-1])
        yield keys[:end], prints[:end], False
        keys, prints = keys[end:], prints[end:]
        if len(keys) > SMALL:
            yield keys, prints, True
            long, keys, prints = keys[-1], keys[:0], prints[:0]
    yield keys, prints, False


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= distance


def _rows(a: np.ndarray, b: np.ndarray, deep: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(deep.view(np.int64))], names=["a", "b", "deep"])


def _variant_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links between different fingerprints of at most `distance` (2 or 3) bits.

    Two halves of 32 bits: one half of a linked pair differs in at most one bit, so both share the half with that bit
    masked. A key holding more than `SMALL` fingerprints is keyed again by the same rule on the other half's two
    quarters; such a key leaves 18 bits open, and inside it neighbours are found by trying the differences on them,
    never by comparing all pairs. No key is cut off.
    """
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for keys, values, long in _groups(batches):
            if not len(keys):
                continue
            sizes = np.bincount(ranks := np.cumsum(np.concatenate(([0], keys[1:] != keys[:-1]))))
            many = (sizes > SMALL)[ranks] | long
            some = ~many & (sizes > 1)[ranks]
            k, f = keys[some], values[some]
            for a, b, key in _pairs_by_shift(k, f):
                bit = key >> np.uint64(32)
                half = np.where(bit < 32, (a ^ b) & np.uint64(0xFFFFFFFF), (a ^ b) >> np.uint64(32))
                ok = _near(a, b, distance) & ((half != 0) | (bit % np.uint64(32) == 0))  # equal halves: at one variant only
                if ok.any():
                    yield _rows(a[ok], b[ok], np.zeros(int(ok.sum()), np.uint64))
            k, f = keys[many], values[many]
            for at in range(0, len(k), 4096):
                key, value = k[at : at + 4096, None], f[at : at + 4096, None]
                other = np.where(key >> np.uint64(32) < 32, value >> np.uint64(32), value & np.uint64(0xFFFFFFFF))
                bit = np.arange(32, dtype=np.uint64)[None, :]
                quarter = ((other & ~(np.uint64(1) << bit)) >> (bit & np.uint64(16))) & np.uint64(0xFFFF)
                deep = (key << np.uint64(21)) | (bit << np.uint64(16)) | quarter
                yield _rows(np.broadcast_to(value, deep.shape).ravel(), np.zeros(deep.size, np.uint64), deep.ravel() + np.uint64(1))
        yield _rows(none, none, none)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _deep_links(batches, distance)

    schema = "a long, b long, deep long"
    keys = prints.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda v: F.struct(
        v.alias("v"), F.col("fingerprint").alias("f")))).alias("x")).select(
        F.expr("(shiftleft(cast(x.v as bigint), 32)) | (case when x.v < 32 then (x.f & ~shiftleft(1L, x.v)) & 4294967295L"
               " else shiftrightunsigned(x.f & ~shiftleft(1L, x.v), 32) end)").alias("key"), F.col("x.f").alias("f"))
    level = kept(keys.repartition("key").sortWithinPartitions("key", "f").mapInArrow(first, schema), "variants")
    deep = level.filter("deep <> 0").select((F.col("deep") - 1).alias("key"), F.col("a").alias("f"))
    more = deep.repartition("key").sortWithinPartitions("key", "f").mapInArrow(second, schema)
    return level.filter("deep = 0").union(more).select("a", "b")


def _deep_links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links inside second-level keys, from rows sorted by key; a crowded key may end with its batch."""
    pending: list[tuple[np.ndarray, np.ndarray]] = []
    for keys, values, long in _groups(batches):
        if not len(keys):
            continue
        if long:
            if pending and pending[-1][0][-1] != keys[0]:
                yield from _dense(np.concatenate([p[1] for p in pending]), pending[0][0][0], distance)
                pending = []
            pending.append((keys, values))
            continue
        if pending:
            yield from _dense(np.concatenate([p[1] for p in pending]), pending[0][0][0], distance)
            pending = []
        sizes = np.bincount(ranks := np.cumsum(np.concatenate(([0], keys[1:] != keys[:-1]))))
        few = (sizes <= SMALL)[ranks]
        for a, b, _ in _pairs_by_shift(keys[few], values[few]):
            ok = _near(a, b, distance)
            if ok.any():
                yield _rows(a[ok], b[ok], np.zeros(int(ok.sum()), np.uint64))
        for rank in np.flatnonzero(sizes > SMALL):
            lo, hi = np.searchsorted(ranks, [rank, rank + 1])
            yield from _dense(values[lo:hi], keys[lo], distance)
    if pending:
        yield from _dense(np.concatenate([p[1] for p in pending]), pending[0][0][0], distance)


def _dense(values: np.ndarray, key: np.uint64, distance: int) -> Iterator[pa.RecordBatch]:
    """Links inside a second-level key: the bits its fingerprints can differ in are few, so every difference is tried."""
    values = np.unique(values)
    open_bits = [b for b in range(64) if int(np.bitwise_or.reduce(values ^ values[0])) >> b & 1]
    masks, layer = [], [0]
    for _ in range(distance):
        layer = sorted({m | 1 << b for m in layer for b in open_bits if not m >> b & 1})
        masks += layer
    for mask in dict.fromkeys(masks):
        other = values ^ np.uint64(mask)
        at = np.minimum(np.searchsorted(values, other), len(values) - 1)
        ok = (values[at] == other) & (values < other)
        if ok.any():
            yield _rows(values[ok], other[ok], np.zeros(int(ok.sum()), np.uint64))


def classes(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fingerprint, root): every fingerprint of the rows and the smallest one it is linked to over any chain."""
    prints = rows.select("fingerprint").distinct()
    roots = components(_variant_links(prints, distance))
    return prints.join(roots, prints["fingerprint"] == roots["node"], "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Each document's fingerprint (long) and the smallest doc_id of its component.

    Needs `doc_id` and `text`; other columns are ignored. Null and blank texts have the fingerprint zero and are linked
    like any other; texts under `shingle` words are one shingle; repeated rows give a row each; ids that are
    null are passed over when the smallest is taken; an empty table gives no rows. Equal fingerprints collapse
    before anything is compared, so copies cost nothing.
    """
    rows = kept(fingerprint_rows(docs.select("doc_id", "text"), shingle).select("doc_id", "fingerprint"), "prints")
    roots = classes(rows, distance)
    least = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("_least")).join(roots, "fingerprint")
    least = kept(least, "classes")
    smallest = least.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = least.join(smallest, "root").select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component, the one of smallest doc_id (ids that are null last); all columns of the input stay."""
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") if c != "text" else F.col("text") for i, c in enumerate(names)])
    rows = fingerprint_rows(plain, shingle).withColumn("_row", F.monotonically_increasing_id())
    rows = kept(rows, "rows")  # written, so the row numbers are fixed
    doc_id = F.col(f"_c{names.index('doc_id')}")
    roots = classes(rows.select("fingerprint"), distance)
    first = rows.groupBy("fingerprint").agg(F.min(F.struct(doc_id.isNull().alias("_null"), doc_id.alias("_id"), F.col("_row"))).alias("_first"))
    stays = first.join(roots, "fingerprint").groupBy("root").agg(F.min("_first").alias("_first")).select(F.col("_first._row").alias("_row"))
    kept_rows = rows.join(stays, "_row", "left_semi")
    return kept_rows.select(*[F.col(f"_c{i}").alias(c) if c != "text" else F.col("text") for i, c in enumerate(names)])
