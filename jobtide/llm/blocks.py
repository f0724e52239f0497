"""Questions and answers between blocks of documents and buckets of keys.

Consecutive documents form blocks of bounded size. Each block asks every bucket about the distinct
keys it holds, a bucket sees all blocks' keys of its share of the key space, and answers each block.
What travels is one packed row per block and bucket, never more rows than keys; a key that fills
a third of the corpus is asked once per block. Any task can be run again.

Blocks times buckets would grow with the square of the corpus. Beyond `DIRECT` buckets the exchange takes two steps: a block sends one
row to each rack of about the square root of all buckets, and a group of as many blocks has its questions of a rack sorted into the
rack's buckets together. Answers go back the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASK = "_bucket int, _block long, payload binary"
ANSWER = "_block long, _bucket int, reply binary"
ASK_ARROW = pa.schema([("_bucket", pa.int32()), ("_block", pa.int64()), ("payload", pa.binary())])
ANSWER_ARROW = pa.schema([("_block", pa.int64()), ("_bucket", pa.int32()), ("reply", pa.binary())])


def cut(batches: Iterator[pa.RecordBatch], at: int, block_bytes: int) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """The rows of one task in blocks of consecutive rows, numbered over all tasks; column `at` is the text.

    A block holds about `block_bytes` of text, one long text at least. The table should be a stored one, so that a task that is
    run again reads the same rows in the same order.
    """
    from pyspark import TaskContext

    number, parts, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for row, n in enumerate(lengths.tolist()):
            size += n
            if size >= block_bytes:
                yield number, [*parts, batch.slice(start, row + 1 - start)]
                number, parts, size, start = number + 1, [], 0, row + 1
        if start < batch.num_rows:
            parts.append(batch.slice(start))
    if parts:
        yield number, parts


def buckets_for(docs: DataFrame, text: str, block_bytes: int) -> int:
    """About as many buckets as there are blocks."""
    return int((docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) // block_bytes) + 1


def blocked(docs: DataFrame, text: str, block_bytes: int) -> tuple[DataFrame, int]:
    """The rows in compressed blocks of consecutive rows (see `cut`), and the number of buckets to ask."""
    at = docs.columns.index(text)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for number, parts in cut(batches, at, block_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parts[0].schema, options=options) as out:
                out.write_table(pa.Table.from_batches(parts).combine_chunks())
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["_block", "packed"])

    return docs.mapInArrow(pack, "_block long, packed binary"), buckets_for(docs, text, block_bytes)


def rows(table: pa.Table) -> pa.Table:
    """The rows of a block."""
    release()
    return pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in table["packed"]])


def release() -> None:
    """Gives freed memory back, as workers live on between tasks."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def by_bucket(keys: np.ndarray, buckets: int) -> list[np.ndarray]:
    """For each bucket the places of its keys in `keys`, which are sorted hashes."""
    cuts = np.searchsorted(keys, np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64))
    return np.split(np.arange(len(keys)), cuts)


DIRECT = 1024


def rack_size(buckets: int, direct: int = DIRECT) -> int:
    """How many buckets share a row: one while there are few, else the square root of all."""
    return 1 if buckets <= direct else ceil(sqrt(buckets))


def _bundle(items: list[tuple[int, bytes]]) -> bytes:
    """Numbered pieces as one."""
    head = np.array([(k, len(x)) for k, x in items], "<i8").reshape(-1, 2)
    return np.array([len(items)], "<i8").tobytes() + head.tobytes() + b"".join(x for _, x in items)


def _unbundle(data: bytes) -> list[tuple[int, bytes]]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    head = np.frombuffer(data, "<i8", 2 * n, 8).reshape(n, 2)
    ends = 8 + 16 * n + np.cumsum(head[:, 1])
    return [(k, data[e - size : e]) for (k, size), e in zip(head.tolist(), ends.tolist(), strict=True)]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def asked(rows: list[tuple[int, int, bytes]], rack: int = 1) -> pa.Table:
    """Questions (bucket, block, payload) of one block as they travel; buckets ascend."""
    if rack > 1:
        rows = [(number, block, _bundle([(r[0], r[2]) for r in some]))
                for (number, block), some in groupby(rows, lambda r: (r[0] // rack, r[1]))]
    return _table(rows, ASK_ARROW)


def _together(questions: DataFrame, rack: int, buckets: int) -> DataFrame:
    """The questions of a rack from a group of blocks, sorted into the rack's buckets."""
    def sort(table: pa.Table) -> pa.Table:
        release()
        held: dict[int, list[tuple[int, bytes]]] = {}
        for block, payload in zip(table["_block"].to_pylist(), table["payload"].to_pylist(), strict=True):
            for bucket, piece in _unbundle(payload):
                held.setdefault(bucket, []).append((block, piece))
        group = table["_group"][0].as_py()
        return _table([(bucket, group, _bundle(pieces)) for bucket, pieces in sorted(held.items())], ASK_ARROW)

    grouped = questions.withColumn("_group", F.pmod(F.xxhash64("_block"), F.lit(ceil(buckets / rack))))
    return grouped.groupBy("_bucket", "_group").applyInArrow(sort, ASK)


def answered(questions: DataFrame, answer: Callable[[list[bytes]], list[bytes]], buckets: int, rack: int = 1, totals: bool = False) -> DataFrame:
    """Each bucket's payloads go to `answer` together, sorted by block; the replies as `delivered` takes them.

    With `totals`, `answer` returns one more piece: the bucket's totals, in a row of block -1.
    """
    def run(table: pa.Table) -> pa.Table:
        release()
        rows = zip(table["_block"].to_pylist(), table["payload"].to_pylist(), strict=True)
        if rack == 1:
            pieces = sorted(((block, payload, block) for block, payload in rows), key=lambda r: r[0])
        else:
            pieces = sorted(((block, piece, group) for group, payload in rows for block, piece in _unbundle(payload)), key=lambda r: r[0])
        bucket, said = table["_bucket"][0].as_py(), answer([p[1] for p in pieces])
        out = [(-1, bucket, said.pop())] if totals else []
        if rack == 1:
            return _table(out + [(p[0], bucket, x) for p, x in zip(pieces, said, strict=True)], ANSWER_ARROW)
        held: dict[int, list[tuple[int, bytes]]] = {}
        for (block, _, group), x in zip(pieces, said, strict=True):
            held.setdefault(group, []).append((block, x))
        return _table(out + [(group, bucket, _bundle(items)) for group, items in sorted(held.items())], ANSWER_ARROW)

    together = questions if rack == 1 else _together(questions, rack, buckets)
    return together.groupBy("_bucket").applyInArrow(run, ANSWER)


def delivered(replies: DataFrame, rack: int = 1) -> DataFrame:
    """The replies by block: one row per bucket, or one per rack with those of its buckets."""
    def sort(table: pa.Table) -> pa.Table:
        release()
        held: dict[int, list[tuple[int, bytes]]] = {}
        for bucket, reply in zip(table["_bucket"].to_pylist(), table["reply"].to_pylist(), strict=True):
            for block, piece in _unbundle(reply):
                held.setdefault(block, []).append((bucket, piece))
        number = table["_rack"][0].as_py()
        return _table([(block, number, _bundle(pieces)) for block, pieces in sorted(held.items())], ANSWER_ARROW)

    if rack == 1:
        return replies
    racked = replies.withColumn("_rack", F.floor(F.col("_bucket") / rack).cast("int"))
    return racked.groupBy("_rack", "_block").applyInArrow(sort, ANSWER)


def answers(questions: DataFrame, answer: Callable[[list[bytes]], list[bytes]], buckets: int, rack: int = 1) -> DataFrame:
    return delivered(answered(questions, answer, buckets, rack), rack)


def replies(table: pa.Table, rack: int = 1) -> dict[int, bytes]:
    """The replies to one block by bucket."""
    rows = zip(table["_bucket"].to_pylist(), table["reply"].to_pylist(), strict=True)
    return dict(rows) if rack == 1 else {bucket: x for _, reply in rows for bucket, x in _unbundle(reply)}
