"""Runs of repeated word sequences inside documents, found by multi-scale minimizers.

A run is a stretch of words with smallest period q, at least max(6, 4q) words long, that no neighbouring word extends. Inside one,
a window and the window q words later hold the same words, so both have their minimum at the same place of the period: the minima
repeat at the distance q. Scale s looks for periods from 2^(s-1) + 1 to 2^s. Its minimizers are the starts whose 2^s words hash
lowest among 2^(s-1) neighbouring starts; the next start with the same words lies one period on, as 2^s words of a run with period
q <= 2^s are alike at multiples of q only. Such a pair seeds an extension by single words to both sides. Periods up to 8 are too
short for windows and are scanned lag by lag.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .encode import slices
from .words import mix, text_bytes

SCAN = 8
FOLDS = 4
SHORTEST = 6
_ODD = np.uint64(0x9E3779B97F4A7C15)
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
RUNS_ARROW = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def _slide(values: np.ndarray, width: int, take: np.ufunc) -> np.ndarray:
    """The least or greatest of each `width` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = take(out[: len(out) - step], out[step:])
        have += step
    return out


def _stretch(ids: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """First and last-but-one place around `at` of the words that equal the word `lag` further on."""
    end, step = at, 64
    while True:
        size = min(step, len(ids) - lag - end)
        unlike = np.flatnonzero(ids[end : end + size] != ids[end + lag : end + lag + size])
        if len(unlike) or not size:
            end += int(unlike[0]) if len(unlike) else 0
            break
        end, step = end + size, 2 * step
    start, step = at, 64
    while True:
        size = min(step, start)
        unlike = np.flatnonzero(ids[start - size : start] != ids[start - size + lag : start + lag])
        if len(unlike) or not size:
            start -= size - 1 - int(unlike[-1]) if len(unlike) else 0
            break
        start, step = start - size, 2 * step
    return start, end


def _smallest(ids: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether no divisor of the period is a period of ids[start:end]."""
    left, factor = period, 2
    while left > 1:
        if left % factor:
            factor = factor + 1 if factor * factor <= left else left
            continue
        q = period // factor
        if np.array_equal(ids[start : end - q], ids[start + q : end]):
            return False
        while left % factor == 0:
            left //= factor
    return True


def _scanned(ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Stretches of the short periods, by comparing every word with the one a lag further on."""
    for lag in range(1, min(SCAN, len(ids) // FOLDS) + 1):
        same = np.concatenate(([False], ids[:-lag] == ids[lag:], [False]))
        edge = np.flatnonzero(same[1:] != same[:-1])
        starts, ends = edge[::2], edge[1::2]
        for k in np.flatnonzero(ends - starts + lag >= max(SHORTEST, FOLDS * lag)):
            yield int(starts[k]), int(ends[k]), lag


def _seeded(ids: np.ndarray, longest: int) -> Iterator[tuple[int, int, int]]:
    """Stretches of the longer periods: pairs of equal minimizers per scale, extended; none is extended twice."""
    hashes, width = mix(ids.astype(np.uint64) * _ODD + _ODD), 1
    while width < longest // FOLDS:
        if len(hashes) <= width:
            return
        hashes = mix(hashes[:-width] * _ODD + (hashes[width:] ^ np.uint64(width)))  # of twice as many words
        low, width = width, 2 * width
        if width <= SCAN:
            continue
        if len(hashes) < low:
            return
        least = _slide(hashes, low, np.minimum)
        edge = np.zeros(low - 1, np.uint64)
        reach = _slide(np.concatenate((edge, least, edge)), low, np.maximum)  # the greatest minimum of the windows around a start
        starts = np.flatnonzero(reach == hashes)
        starts = starts[np.argsort(hashes[starts], kind="stable")]
        lags, alike = np.diff(starts), hashes[starts[1:]] == hashes[starts[:-1]]
        seeds = np.flatnonzero(alike & (lags > max(low, SCAN)) & (lags <= width))
        done: dict[int, int] = {}
        for at, lag in sorted(zip(starts[seeds].tolist(), lags[seeds].tolist(), strict=True)):
            if at >= done.get(lag, 0):
                start, end = _stretch(ids, at, lag)
                done[lag] = max(end, at + 1)
                yield start, end, lag


def runs_of(ids: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """Start, length and period of every run among word numbers, by start and period.

    Several documents may follow each other if a number that occurs once stands between them: no stretch then reaches across.
    `longest` is the number of words of the longest one.
    """
    found = set()
    for kind in (_scanned(ids), _seeded(ids, longest)):
        for start, end, lag in kind:
            if end - start + lag >= max(SHORTEST, FOLDS * lag) and _smallest(ids, start, end + lag, lag):
                found.add((start, end - start + lag, lag))
    return sorted(found)


def _documents(texts: list[bytes]) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """The words of each text and its runs; short texts share the array work, long ones have it for themselves."""
    words = [t.split() for t in texts]
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    found: list[list[tuple[int, int, int]]] = [[] for _ in words]
    at = 0
    while at < len(order):
        size, group, longest = 0, [], max(64, 2 * len(words[order[at]]))  # texts of like length, so that few scales are in vain
        while at < len(order) and size < 1 << 18 and len(words[order[at]]) <= longest:
            group.append(order[at])
            size += len(words[order[at]]) + 1
            at += 1
        numbers: defaultdict[bytes | tuple[int], int] = defaultdict(count().__next__)
        ids, first = np.empty(size, np.int64), [0]
        for k in group:
            a, b = first[-1], first[-1] + len(words[k])
            ids[a:b] = list(map(numbers.__getitem__, words[k]))
            ids[b] = numbers[(k,)]  # occurs once
            first.append(b + 1)
        for start, length, period in runs_of(ids, len(words[group[-1]])):
            at_doc = int(np.searchsorted(first, start, "right")) - 1
            found[group[at_doc]].append((start - first[at_doc], length, period))
    return zip(words, found, strict=True)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside runs and in a run's first period, joined by one blank."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words), bool)
    for start, length, period in runs:
        drop[start + period : start + length] = True
    return b" ".join([words[k] for k in np.flatnonzero(~drop).tolist()])


def find_runs(docs: DataFrame) -> DataFrame:
    """Every document's runs and its text without their repetitions: (doc_id, n_words, runs, strongest, collapsed).

    `runs` has start (word number), length and period, by start and then period. `strongest` is the one with the greatest length
    per period (ties: the smallest start, then period), null without runs. A word is dropped from `collapsed` if any run holds it
    after that run's first period; the others are joined by one blank.

    Needs `doc_id` and `text`; other columns are ignored, whatever their names. A null, empty or blank text has no words and no
    runs; a null id stays null; repeated rows are read each; an empty table gives no rows. Whole texts are read; nothing is shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for part in slices(texts):
                found = list(_documents(texts[part]))
                best = [min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None) for _, runs in found]
                as_rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for _, runs in found]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.start, len(found)), pa.array([len(w) for w, _ in found], pa.int64()), pa.array(as_rows, RUNS_ARROW),
                    pa.array([b and dict(zip(("start", "length", "period"), b, strict=True)) for b in best], RUNS_ARROW.value_type),
                    pa.array([_collapsed(w, r) for w, r in found], pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "strongest", "collapsed"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS),
                           T.StructField("strongest", RUNS.elementType), T.StructField("collapsed", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def with_repeats(doc_id: Column, text: Column) -> Column:
    """A text whose words repeat from some place on, for about a tenth of the ids; the others stay as they are.

    With h the crc32 of the id as text and g = floor(h / 10): if 10 divides h and there are n > 0 words, each word i >= a becomes
    word a + (i - a) mod p, where a = g mod n and p = 1 + floor((n - a) / (3 + g mod 8)). A null id changes nothing.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % F.nullif(n, F.lit(0))).cast("int")
    p = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    repeated = F.slice(F.concat(F.slice(words, 1, a), tail), 1, n)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(repeated, " ")).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """Counts, the strongest run and hashes of what `find_runs` returns."""
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    said = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(said, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
