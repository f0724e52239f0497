"""TF-IDF near-duplicate search, exact at its threshold.

Texts become unit vectors of smooth TF-IDF weights. Equal texts are collapsed before anything is compared. The vectors
of each side are packed into blocks, and every block of new texts meets every block of existing ones. A task bounds the cosines of all
pairs of two blocks with one product of short sketches, and measures those pairs whose bound reaches the threshold and what is known of the
best match so far. Only the best match of each text of a block leaves the task, so nothing that grows with the number of pairs is
shuffled or written.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.core import bind
from ..functions.text import fold, strip_html
from ..session import kept
from .keyed import best_match

TOKEN = r"[\p{L}\p{N}_]{2,}"
WIDTH = 3072  # texts of a block
ENTRIES = 1 << 20  # terms of all texts of a block, if it has more than one
OFTEN = 0.002  # a term is frequent in two blocks if it is shared by more than this share of their pairs
COLUMNS = 1024  # frequent terms that are multiplied at once
CELLS = 1 << 16  # pairs whose rare terms are summed at once
PRODUCTS = 1 << 21  # terms of pairs that are sought at once
SKETCH = 512  # lengths that bound the cosine of two texts
ROUNDING = 1e-4  # of a bound in single precision
SLACK = 1e-9


def terms(text: Column, stop_words: Sequence[str] = (), bigrams: bool = True) -> Column:
    """Folded words of two letters or more, then pairs of neighbours."""
    words = F.regexp_extract_all(fold(text), F.lit(TOKEN), F.lit(0))
    if stop_words:
        words = F.filter(words, lambda w: ~w.isin(*stop_words))
    if not bigrams:
        return words

    def with_pairs(ws: Column) -> Column:
        nexts = F.slice(ws, F.lit(2), F.greatest(F.size(ws) - 1, F.lit(0)))
        pairs = F.slice(F.zip_with(ws, nexts, lambda a, b: F.concat_ws(" ", a, b)),
                        F.lit(1), F.greatest(F.size(ws) - 1, F.lit(0)))
        return F.concat(ws, pairs)

    return F.transform(F.array(words), with_pairs)[0]


def text_key(text: str) -> Column:
    return F.unhex(F.sha2(text, 256))


def term_counts(texts: DataFrame, stop_words: Sequence[str], bigrams: bool) -> DataFrame:
    """Occurrences of each term in each distinct text of each side.

    Equal texts become one: `doc` is their smallest key, `copies` their number and `n` a short name for it.
    Terms are counted where the texts were collapsed, without another shuffle. A
    text without terms keeps one row with a null term.
    """
    distinct = texts.groupBy("side", text_key("text").alias("text_hash")).agg(
        F.min("id").alias("doc"), F.count("*").alias("copies"), F.first("text").alias("text"))
    distinct = distinct.withColumn("n", F.monotonically_increasing_id())
    keys = ["n", "side", "text_hash", "doc", "copies"]
    words = distinct.select(*keys, F.explode_outer(terms(F.col("text"), stop_words, bigrams)).alias("term"))
    return words.groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def term_weights(counts: DataFrame, total: Column, max_features: int | None) -> DataFrame:
    """Number, document frequency and idf `ln((1 + n) / (1 + df)) + 1` of each kept term.

    With `max_features` only the terms that occur most often stay. Terms are
    numbered inside hash ranges, so that no step sees the whole vocabulary.
    """
    stats = counts.groupBy("term").agg(
        F.sum("copies").alias("df"), F.sum(F.col("tf") * F.col("copies")).alias("uses"))
    if max_features:
        stats = stats.orderBy(F.col("uses").desc(), "term").limit(max_features)
    part = F.pmod(F.xxhash64("term"), F.lit(4096))
    place = F.row_number().over(Window.partitionBy("part").orderBy("term"))
    return stats.withColumn("part", part).select(
        "term", (F.col("part") * (1 << 40) + place).alias("tid"), "df",
        (F.log((1 + total) / (1 + F.col("df"))) + 1).alias("idf"))


def unit_vectors(counts: DataFrame, weights: DataFrame) -> DataFrame:
    """Unit vector of each text by its short name `n`, as arrays of term numbers and weights."""
    rows = counts.join(weights, "term").select("n", "tid", (F.col("tf") * F.col("idf")).alias("x"))
    vectors = rows.groupBy("n").agg(F.sort_array(F.collect_list(F.struct("tid", "x"))).alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e["x"] * e["x"]))
    return vectors.select("n", F.col("v.tid").alias("tids"), bind(length, lambda n: F.transform("v", lambda e: e["x"] / n)).alias("ws"))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several ranges, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class _Block:
    """Vectors of some texts, by term: the texts that hold a term and their weights lie side by side."""

    KINDS = {"terms": "<i8", "starts": "<i8", "texts": "<i4", "ws": "<f8"}

    def __init__(self, texts_held: int, **arrays: np.ndarray) -> None:
        self.n = texts_held
        self.terms, self.starts, self.texts, self.ws = (arrays[k] for k in self.KINDS)
        self.sizes = np.diff(self.starts)

    @staticmethod
    def packed(sizes: np.ndarray, tids: np.ndarray, ws: np.ndarray) -> list[bytes]:
        order = np.argsort(tids, kind="stable")
        terms, starts = np.unique(tids[order], return_index=True)
        texts = np.repeat(np.arange(len(sizes)), sizes)[order]
        arrays = (terms, np.append(starts, len(tids)), texts, ws[order])
        return [x.astype(kind).tobytes() for x, kind in zip(arrays, _Block.KINDS.values(), strict=True)]

    @classmethod
    def read(cls, row: dict, side: str) -> _Block:
        return cls(len(row[f"{side}_docs"]), **{k: np.frombuffer(row[f"{side}_{k}"].as_buffer(), kind) for k, kind in cls.KINDS.items()})

    @cached_property
    def sketch(self) -> np.ndarray:
        """The lengths of what each text holds of each of some groups of terms: their products sum to the cosine at least."""
        group = (self.terms.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) * SKETCH >> 24  # from the highest bits
        squares = np.bincount(self.texts * np.int64(SKETCH) + np.repeat(group, self.sizes), self.ws * self.ws, self.n * SKETCH)
        return np.sqrt(squares).astype(np.float32).reshape(self.n, SKETCH)

    def only(self, texts: np.ndarray) -> _Block:
        """The block of some of its texts."""
        place = np.full(self.n, -1, np.int32)
        place[texts] = np.arange(len(texts))
        mine = np.flatnonzero(place[self.texts] >= 0)
        sizes = np.bincount(np.repeat(np.arange(len(self.terms)), self.sizes)[mine], minlength=len(self.terms))
        starts = np.append(0, np.cumsum(sizes[sizes > 0]))
        return _Block(len(texts), terms=self.terms[sizes > 0], starts=starts, texts=place[self.texts[mine]], ws=self.ws[mine])

    def dense(self, at: np.ndarray) -> np.ndarray:
        """One column for each of some terms."""
        places = _ranges(self.starts[at], self.sizes[at])
        out = np.zeros((self.n, len(at)))
        out[self.texts[places], np.repeat(np.arange(len(at)), self.sizes[at])] = self.ws[places]
        return out

    def by_text(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term (as a place in `at`) and weight of the entries of some terms, by text and then by place."""
        places = _ranges(self.starts[at], self.sizes[at])
        text = self.texts[places]
        order = np.argsort(text.astype(np.min_scalar_type(self.n)), kind="stable")  # small numbers are sorted by their digits
        return text[order].astype(np.int64), np.repeat(np.arange(len(at)), self.sizes[at])[order], self.ws[places[order]]


def _shared(new: _Block, ref: _Block) -> tuple[np.ndarray, np.ndarray]:
    """The places in either block of the terms that both hold."""
    return np.intersect1d(new.terms, ref.terms, assume_unique=True, return_indices=True)[1:]


def _cosines(new: _Block, ref: _Block) -> np.ndarray:
    """Cosine of each new text and each existing one.

    Terms that many pairs share are multiplied as matrices; for the rare ones, the lists of existing texts are added up text by text.
    """
    at, there = _shared(new, ref)
    often = new.sizes[at] * ref.sizes[there] > OFTEN * new.n * ref.n
    x, y = at[often], there[often]
    out = new.dense(x[:COLUMNS]) @ ref.dense(y[:COLUMNS]).T
    for lo in range(COLUMNS, len(x), COLUMNS):
        out += new.dense(x[lo : lo + COLUMNS]) @ ref.dense(y[lo : lo + COLUMNS]).T
    text, term, ws = new.by_text(at[~often])
    starts, sizes = ref.starts[there[~often]][term], ref.sizes[there[~often]][term]
    step = max(1, CELLS // ref.n)
    cuts = np.searchsorted(text, np.arange(0, new.n + step, step))
    for lo, a, b in zip(range(0, new.n, step), cuts, cuts[1:], strict=False):
        if a < b:
            rows, many = min(step, new.n - lo), sizes[a:b]
            places = _ranges(starts[a:b], many)
            cells = np.repeat((text[a:b] - lo) * ref.n, many) + ref.texts[places]
            out[lo : lo + rows] += np.bincount(cells, np.repeat(ws[a:b], many) * ref.ws[places], rows * ref.n).reshape(rows, -1)
    return out


def _pairs(new: _Block, ref: _Block, j: np.ndarray) -> np.ndarray:
    """Cosine of each new text and one existing text of its own."""
    at, there = _shared(new, ref)
    text, term, ws = new.by_text(at)
    out, keys, ws = np.zeros(new.n), np.append(text * len(at) + term, np.iinfo(np.int64).max), np.append(ws, 0.0)
    text, term, other = ref.by_text(there)
    starts = np.searchsorted(text, j)
    sizes = np.searchsorted(text, j, "right") - starts
    ends, lo = np.cumsum(sizes), 0
    while lo < new.n:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PRODUCTS, "right")))
        places, pair = _ranges(starts[lo:hi], sizes[lo:hi]), np.repeat(np.arange(lo, hi), sizes[lo:hi])
        asked = pair * len(at) + term[places]
        found = np.searchsorted(keys, asked)
        out[lo:hi] = np.bincount(pair - lo, np.where(keys[found] == asked, ws[found] * other[places], 0.0), hi - lo)
        lo = hi
    return out


def _best(new: _Block, ref: _Block, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The new texts that have a cosine of at least `least`, their best existing text, the first on ties, and its cosine.

    Sketches bound the cosines of all pairs. The likeliest partner of each text is measured first; then those of all pairs
    whose bound is not under what is known, and every such pair is.
    """
    bounds = new.sketch @ ref.sketch.T + np.float32(ROUNDING)
    first = bounds.argmax(axis=1)
    rows = np.flatnonzero(bounds[np.arange(new.n), first] >= least)
    if not len(rows):
        return rows, rows, np.zeros(0)
    first, least, new = first[rows], least[rows], new.only(rows)
    partners, at = np.unique(first, return_inverse=True)
    scores = np.round(_pairs(new, ref.only(partners), at), 12)
    may = bounds[rows] >= np.maximum(scores, least)[:, None]
    may[np.arange(len(rows)), first] = False
    more, others = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
    if len(more):
        cosines = np.round(_cosines(new.only(more), ref.only(others)), 12)
        best = cosines.argmax(axis=1)
        found = cosines[np.arange(len(more)), best]
        best, known = others[best], scores[more]
        better = (found > known) | (found == known) & (best < first[more])
        first[more[better]], scores[more[better]] = best[better], found[better]
    top = scores >= least
    return rows[top], first[top], scores[top]


def _blocks(vectors: DataFrame, side: str, width: int) -> DataFrame:
    """The vectors of one side in blocks of at most `width` texts, each in the order of its keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pc.sort_indices(batch.column(0), null_placement="at_start"))
            docs, tids, ws = batch.columns
            sizes = pc.list_value_length(tids).to_numpy(zero_copy_only=False)
            ends, lo = np.cumsum(sizes), 0
            many = max(1, -(-len(docs) // width))
            even = -(-len(docs) // many)  # no block of a few texts is left over
            tids, ws = tids.flatten().to_numpy(zero_copy_only=False), ws.flatten().to_numpy(zero_copy_only=False)
            while lo < len(docs):
                first = ends[lo - 1] if lo else 0
                hi = min(lo + even, max(lo + 1, int(np.searchsorted(ends, first + ENTRIES, "right"))))
                parts = _Block.packed(sizes[lo:hi], tids[first : ends[hi - 1]], ws[first : ends[hi - 1]])
                keys = pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), docs.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([keys, *(pa.array([p], pa.binary()) for p in parts)], names=names)
                lo = hi

    names = [f"{side}_{k}" for k in ("docs", *_Block.KINDS)]
    schema = T.StructType([T.StructField(names[0], T.ArrayType(vectors.schema["doc"].dataType)), *(T.StructField(n, T.BinaryType()) for n in names[1:])])
    rows = vectors.filter((F.col("side") == side) & F.col("doc").isNotNull()).select("doc", "tids", "ws")
    return rows.mapInArrow(run, schema)


def best_pairs(vectors: DataFrame, threshold: float, width: int = WIDTH) -> DataFrame:
    """Best reference of each query vector with cosine of at least `threshold`; the smaller one on ties.

    `vectors` holds both sides (`new` and `ref`). Every pair of blocks is read by one task; the memory of a task
    is bounded by the size of two blocks. A text whose match is known in a task asks for better ones only.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, new, least = None, None, None
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                asked = [row[name] for name in row if name.startswith("new_")]
                if mine is None or not all(x.equals(y) for x, y in zip(asked, mine, strict=True)):
                    mine, new = asked, _Block.read(row, "new")
                    least = np.full(new.n, threshold - SLACK)
                found, best, scores = _best(new, _Block.read(row, "ref"), least)
                least[found] = scores
                yield pa.RecordBatch.from_arrays([row["new_docs"].values.take(pa.array(found)), row["ref_docs"].values.take(pa.array(best)),
                                                  pa.array(scores)], names=["query", "ref", "score"])

    asked, there = (kept(_blocks(vectors, side, width), f"{side}-blocks") for side in ("new", "ref"))
    key = vectors.schema["doc"].dataType
    schema = T.StructType([T.StructField("query", key), T.StructField("ref", key), T.StructField("score", T.DoubleType())])
    scores = asked.crossJoin(there).mapInArrow(run, schema)
    return best_match(scores.filter(F.col("score") >= threshold - SLACK), "query", "ref", "score")


def find_near_duplicates(new: DataFrame, existing: DataFrame, *, threshold: float = 0.75,
                         max_features: int | None = None, min_corpus: int = 0,
                         stop_words: Sequence[str] = (), bigrams: bool = True,
                         min_length: int = 0, text: str = "description",
                         fit_on_both: bool = False, strip_tags: bool = True) -> DataFrame:
    """Match table of postings whose text is close to an existing one.

    The vocabulary comes from the existing texts, or from both sides with
    `fit_on_both`. All terms, texts and corpus sizes count by default: `max_features` keeps the terms that
    occur most often, `min_length` leaves out new texts that are shorter and existing ones that are not
    longer, and nothing matches while the corpus is smaller than `min_corpus`.
    """
    clean = strip_html(text) if strip_tags else F.coalesce(F.col(text), F.lit(""))
    refs = existing.select("id", clean.alias("text")).filter(F.length("text") > min_length)
    asked = new.select("id", clean.alias("text")).filter(F.length("text") >= max(min_length, 1))
    both = refs.withColumn("side", F.lit("ref")).unionByName(asked.withColumn("side", F.lit("new")))
    counts = kept(term_counts(both, stop_words, bigrams), "term-counts")
    heads = kept(counts.select("n", "side", "text_hash", "doc", "copies").distinct(), "heads")
    corpus = heads if fit_on_both else heads.filter("side = 'ref'")
    total = corpus.agg(F.coalesce(F.sum("copies"), F.lit(0))).scalar()
    used = counts.filter("term is not null")
    fitted = used if fit_on_both else used.filter("side = 'ref'")
    vectors = unit_vectors(used, term_weights(fitted, total, max_features)).join(heads.drop("copies"), "n")
    vectors = kept(vectors, "vectors").filter(total >= min_corpus)
    asked_hashes, ref_hashes = (vectors.filter(F.col("side") == s).select("text_hash", F.col("doc").alias(n))
                                for s, n in (("new", "query"), ("ref", "ref")))
    # Equal texts need no search: their cosine is one.
    equal = asked_hashes.join(ref_hashes, "text_hash").select("query", "ref", F.lit(1.0).alias("score"))
    done = equal.select(F.col("query").alias("doc"), F.lit("new").alias("side"))
    pairs = best_pairs(vectors.join(done, ["doc", "side"], "left_anti").select(*vectors.columns), threshold)
    # Every copy of a query text gets the match of its representative.
    members = asked.select("id", text_key("text").alias("text_hash")).join(
        heads.filter("side = 'new'").select("text_hash", F.col("doc").alias("query")), "text_hash")
    return members.join(equal.unionByName(pairs), "query").select(
        F.col("id").alias("duplicate_id"), F.col("ref").alias("original_id"),
        F.lit("tfidf").alias("match_type"), F.col("score").alias("similarity"))


def match_incoming(master: DataFrame, incoming: DataFrame, known: DataFrame, *,
                   threshold: float = 0.75, min_corpus: int = 0,
                   stop_words: Sequence[str] = ()) -> DataFrame:
    """Incoming rows that the master list holds, and how they were told.

    `KEY_ID`: same key. `EXISTING_TFIDF`: key known as a content duplicate.
    `NEW_TFIDF`: text close to a master row; words of both sides are counted.
    Rows need `id`, `key_id` and `description`.
    """
    by_key = incoming.select("id", "key_id").join(
        master.select("key_id", F.col("id").alias("original_id")), "key_id").select(
        F.col("id").alias("duplicate_id"), "original_id", F.lit("KEY_ID").alias("match_type"),
        F.lit(1.0).alias("similarity"))
    left = incoming.join(master.select("key_id"), "key_id", "left_anti")
    by_known = left.join(known.select("key_id"), "key_id", "left_semi").select(
        F.col("id").alias("duplicate_id"), F.lit(None).cast("long").alias("original_id"),
        F.lit("EXISTING_TFIDF").alias("match_type"), F.lit(1.0).alias("similarity"))
    open_rows = left.join(known.select("key_id"), "key_id", "left_anti")
    near = find_near_duplicates(
        open_rows, master, threshold=threshold, max_features=None, min_corpus=min_corpus,
        stop_words=stop_words, bigrams=False, min_length=0, fit_on_both=True, strip_tags=False)
    return by_key.unionByName(by_known).unionByName(
        near.withColumn("match_type", F.lit("NEW_TFIDF")))
