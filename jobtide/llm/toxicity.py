"""Toxic texts by a subsequence string kernel and a support vector machine on Nyström landmarks.

The kernel compares words by the three-letter subsequences they share; a letter more inside the span of a
subsequence costs a factor. Marks are dropped, look-alike digits read as letters and runs of single letters joined
first, so that gaps and inserted characters leave most of the subsequences in place.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .encode import slices
from .frames import numbered
from .words import Hasher, mix, text_bytes, window_hashes

DECAY, SPAN = 0.6, 7
LANDMARKS, WINDOW = 160, 16
SAMPLE = 2_000  # labelled rows of each class that the fit may use
ROUNDS, NEGATIVES = 4, 6_000
_EDGE = 31
_LOOK_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}  # fixed values


def _alphabet() -> tuple[bytes, bytes]:
    """A table from Latin-1 bytes to letters a-z and blanks, and the bytes to drop."""
    table, drop = bytearray(256), bytearray()
    for i in range(256):
        c = chr(i)
        base = unicodedata.normalize("NFKD", c).lower()[0]
        letter = "s" if c == "ß" else _LOOK_ALIKE.get(c, base if "a" <= base <= "z" else "")
        if c in " \t\n\v\f\r\x85\xa0":
            table[i] = 32
        elif letter:
            table[i] = ord(letter)
        else:
            drop.append(i)
    return bytes(table), bytes(drop)


class _Letters(dict):
    """What a character is read as: letters a-z where its parts or its name hold them, else one or two of the kernel's 31 codes; marks are dropped."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if code < 256 and not c.isalpha():
            table, drop = _alphabet()
            self[code] = "" if code in drop else chr(table[code])
        else:
            self[code] = " " if c.isspace() else "".join(map(_letter, unicodedata.normalize("NFKD", c).lower()))
        return self[code]


def _letter(c: str) -> str:
    if "a" <= c <= "z" or c in _LOOK_ALIKE:
        return _LOOK_ALIKE.get(c, c)
    kind, name, code = unicodedata.category(c), unicodedata.name(c, ""), ord(c)
    sign = kind in ("Mc", "Mn") and not unicodedata.combining(c) and "VARIATION" not in name and "JOINER" not in name  # vowel signs
    if kind[0] != "L" and not sign:
        return ""
    latin = re.match(r"LATIN SMALL (?:LETTER|LIGATURE) (?:DOTLESS )?([A-Z]{1,2})(?: WITH .*)?$", name)
    if c == "ß" or latin:
        return "s" if c == "ß" else latin[1].lower()
    return ("" if code < 0x2E80 else chr(96 + code // 31 % 31)) + chr(96 + code % 31)


_LETTERS = _Letters()


def _plain(texts: list[bytes]) -> list[bytes]:
    table, drop = _alphabet()
    return [t.translate(table, drop) if t.isascii() else t.decode("utf-8", "replace").translate(_LETTERS).encode("ascii") for t in texts]


class Words:
    """The different words of some texts as letters, and which text has which."""

    def __init__(self, texts: list[bytes]) -> None:
        data, starts, ends, hashes, first = Hasher().documents(_plain(texts))
        owner = np.repeat(np.arange(len(texts)), np.diff(first))
        _, pick, where = np.unique(hashes, return_index=True, return_inverse=True)
        raw = np.frombuffer(data, np.uint8)
        self.letters, self.sizes = _flat(raw, starts[pick], ends[pick])
        self.word, self.owner, self.n_texts, self.hashes, self.plain = where, owner, len(texts), hashes, len(owner)
        spelled, spellers = self._spelled(data, starts, ends, owner)
        if spelled:
            more = np.frombuffer(b"".join(spelled), np.uint8)
            self.word = np.concatenate((self.word, len(self.sizes) + np.arange(len(spelled))))
            self.owner = np.concatenate((self.owner, spellers))
            self.letters, self.sizes = np.concatenate((self.letters, more)), np.concatenate((self.sizes, [len(s) for s in spelled]))

    @staticmethod
    def _spelled(data: bytes, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> tuple[list[bytes], list[int]]:
        """Runs of three or more words of one letter, as one word each."""
        one = np.concatenate(([0], (ends - starts == 1).astype(np.int8), [0]))
        edge = np.diff(one)
        words, owners = [], []
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            if b - a >= 3 and owner[a] == owner[b - 1]:
                words.append(bytes(data[i] for i in starts[a:b].tolist()))
                owners.append(int(owner[a]))
        return words, owners


def _flat(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = ends - starts
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
    return raw[at], sizes


def subsequences(letters: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(window, subsequence, weight) of all words, one offset pair at a time. A word has its edges marked.

    Words over `WINDOW` letters are seen as overlapping windows; see `windows`.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    codes = np.where(letters == _EDGE, _EDGE, letters & 31).astype(np.int64)
    for b in range(2, SPAN):
        if len(codes) <= b:
            return
        same = owner[b:] == owner[:-b]
        at = np.flatnonzero(same)
        for a in range(1, b):
            yield owner[at], (codes[at] << 10) | (codes[at + a] << 5) | codes[at + b], DECAY ** (b + 1)


def windows(letters: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marked words, long ones cut into half-overlapping windows; and the word of each window."""
    step = WINDOW // 2
    first = np.cumsum(sizes) - sizes
    n = np.maximum(1, -(-(sizes - WINDOW) // step) + 1)
    word = np.repeat(np.arange(len(sizes)), n)
    part = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
    start = first[word] + part * step
    end = np.minimum(start + WINDOW, first[word] + sizes[word])
    size = end - start + 2
    out = np.full(size.sum(), _EDGE, np.uint8)
    begin = np.cumsum(size) - size
    inner = np.ones(len(out), bool)
    inner[begin] = inner[begin + size - 1] = False
    out[inner] = _flat(letters, start, end)[0]
    return out, size, word


def margins(letters: np.ndarray, sizes: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """The machine's margin of each word: that of its best window."""
    if not len(sizes):
        return np.zeros(0)
    if len(sizes) > 1 << 15:  # in parts, to bound memory
        cuts = np.arange(0, len(sizes), 1 << 15)
        ends = np.append(cuts[1:], len(sizes))
        at = np.concatenate(([0], np.cumsum(sizes)))
        return np.concatenate([margins(letters[at[a] : at[b]], sizes[a:b], weights, bias) for a, b in zip(cuts, ends, strict=True)])
    text, size, word = windows(letters, sizes)
    dot, norm = np.zeros(len(size)), np.zeros(len(size))
    for owner, code, weight in subsequences(text, size):
        dot += weight * np.bincount(owner, weights=weights[code], minlength=len(size))
        norm += weight * weight * np.bincount(owner, minlength=len(size))
    each = dot / np.sqrt(np.maximum(norm, 1e-12)) + bias
    return np.maximum.reduceat(each, np.searchsorted(word, np.arange(len(sizes))))


def _gaps(units: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(unit, subsequence, share) of a few units, normalised. A unit is a word or a window of a longer one."""
    text, size, _ = windows(np.frombuffer(b"".join(units), np.uint8), np.array([len(w) for w in units]))
    parts = [(owner, code, np.full(len(code), weight)) for owner, code, weight in subsequences(text, size)]
    owner, code, weight = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3
    norm = np.sqrt(np.maximum(np.bincount(owner, weights=weight * weight, minlength=len(size)), 1e-12))
    order = np.argsort(owner, kind="stable")
    yield owner[order], code[order], (weight / norm[owner])[order]


def _vectors(words: list[bytes]) -> np.ndarray:
    """Dense normalised subsequence vectors of the landmarks."""
    out = np.zeros((len(words), 1 << 15), np.float32)
    for owner, code, weight in _gaps(words):
        np.add.at(out, (owner, code), weight)
    return out


def _kernel(words: list[bytes], landmarks: np.ndarray) -> np.ndarray:
    """The kernel of each word with each landmark."""
    rows, out = np.ascontiguousarray(landmarks.T), np.zeros((len(words), len(landmarks)))
    for at in range(0, len(words), 200):
        for owner, code, weight in _gaps(words[at : at + 200]):
            if len(owner):
                new = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                out[at + owner[new]] = np.add.reduceat(rows[code] * weight[:, None].astype(np.float32), new, axis=0)
    return out


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 60) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, by Newton steps on the violators."""
    x = np.hstack((x, np.ones((len(x), 1))))
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(steps):
        active = y * (x @ w) < 1
        xa, ca = x[active], cost[active][:, None]
        new = np.linalg.solve(ridge + xa.T @ (ca * xa), xa.T @ (ca[:, 0] * y[active]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = 0.5 * w + 0.5 * new if _ > 10 else new
    return w[:-1], float(w[-1])


@dataclass
class Model:
    """Subsequence weights (the landmarks' kernels summed up), a bias, and the line that turns a margin into log odds."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        words = Words(texts)
        each = margins(words.letters, words.sizes, self.weights, self.bias)
        best = np.full(len(texts), min(-1.0, self.bias))
        np.maximum.at(best, words.owner, each[words.word])
        return 1 / (1 + np.exp(-np.clip(self.slope * best + self.shift, -30, 30)))


def _apart(words: Words, n_signs: int = 4) -> np.ndarray:
    """The texts that share no minimum over neighbouring words with an earlier one: copies must not count as evidence."""
    stay, seen = np.ones(words.n_texts, bool), [set() for _ in range(n_signs)]
    at = np.concatenate(([0], np.cumsum(np.bincount(words.owner[: words.plain], minlength=words.n_texts))))
    for i in range(words.n_texts):
        hashes = window_hashes(words.hashes[at[i] : at[i + 1]], 5)
        if not len(hashes):
            continue
        signs = [int(mix(hashes + np.uint64(k)).min()) for k in range(n_signs)]
        stay[i] = not any(s in have for s, have in zip(signs, seen, strict=True))
        for s, have in zip(signs, seen, strict=True):
            have.add(s)
    return stay


def _units(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different units of the words as letters and sizes, and which text has which: (letters, sizes, text, unit) with each pair once.

    A word is one unit, a word over `WINDOW` letters is as many as scoring looks at: all its windows.
    """
    text, size, word = windows(words.letters, words.sizes)
    first = np.cumsum(size) - size
    table = np.zeros((len(size), WINDOW), np.uint8)
    inner = size - 2
    table[np.repeat(np.arange(len(size)), inner), np.arange(inner.sum()) - np.repeat(np.cumsum(inner) - inner, inner)] = _flat(text, first + 1, first + 1 + inner)[0]
    units, unit = np.unique(table.view(f"S{WINDOW}").ravel(), return_inverse=True)
    sizes = np.char.str_len(units).astype(np.int64)
    letters = np.frombuffer(b"".join(units.tolist()), np.uint8)
    starts = np.searchsorted(word, np.arange(len(words.sizes) + 1))
    n = np.diff(starts)[words.word]
    each = np.repeat(starts[words.word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    pairs = np.unique(np.repeat(words.owner.astype(np.int64), n) * len(units) + unit[each])
    return letters, sizes, pairs // max(len(units), 1), pairs % max(len(units), 1)


def _witnesses(letters: np.ndarray, sizes: np.ndarray, owner: np.ndarray, unit: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Where no unit comes again in toxic texts: of each toxic text the unit whose letter triples are found there rather than elsewhere."""
    text, size, _ = windows(letters, sizes)
    of, code, _ = next(subsequences(text, size), (np.zeros(0, np.int64), np.zeros(0, np.int64), 0.0))
    first = np.searchsorted(of, np.arange(len(sizes) + 1))
    n = np.diff(first)[unit]
    each = np.repeat(first[unit] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    held = np.unique(np.repeat(owner, n) << 15 | code[each])
    bad, good = (np.bincount(held[toxic[held >> 15] == t] & 0x7FFF, minlength=1 << 15) for t in (True, False))
    odds = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((good + 0.5) / ((~toxic).sum() + 1))
    value = np.bincount(of, weights=np.maximum(odds[code], 0), minlength=len(sizes))
    mine = np.flatnonzero(toxic[owner])
    order = mine[np.lexsort((value[unit[mine]], owner[mine]))]
    last = np.append(np.flatnonzero(owner[order][1:] != owner[order][:-1]), len(order) - 1) if len(order) else order
    return np.unique(unit[order[last]])


def fit(texts: list[bytes], toxic: np.ndarray) -> Model:
    """Learns from labelled texts which words mark a toxic one.

    A toxic text has at least one toxic unit (a word, or a window of a long one), unknown which. Units far more frequent in toxic texts start as
    positives; a toxic text without a unit of positive margin adds its best one (its witness). Units of other texts are negatives, the
    worst of them found again in each round. With one class only, every text gets its share of toxic labels as score.
    """
    toxic = toxic.astype(bool)
    if not toxic.any() or toxic.all():
        odds = 30.0 if len(toxic) and toxic.all() else -30.0
        return Model(np.zeros(1 << 15), 0.0, 0.0, odds)
    words = Words(texts)
    stay = _apart(words)
    letters, sizes, owner, word = _units(words)
    n, first = len(sizes), np.cumsum(sizes) - sizes
    spell = lambda i: letters[first[i] : first[i] + sizes[i]].tobytes()
    good = np.bincount(word[~toxic[owner]], minlength=n)
    own = stay[owner]
    bad = np.bincount(word[own & toxic[owner]], minlength=n)
    rest = np.bincount(word[own & ~toxic[owner]], minlength=n)
    odds = np.log((bad + 0.05) / max(1, (stay & toxic).sum())) - np.log((rest + 0.5) / max(1, (stay & ~toxic).sum()))
    telling = (bad >= 3) & (odds > 3) & (sizes >= 3)
    if not telling.any():
        telling[_witnesses(letters, sizes, owner, word, toxic)] = True
    clean = np.flatnonzero((good > 0) & ~telling)
    rng, hard = np.random.default_rng(0), np.zeros(0, np.int64)
    mine = np.flatnonzero(toxic[owner] & (sizes[word] >= 3))
    for step in range(ROUNDS):
        chosen = np.flatnonzero(telling)
        top = chosen[np.argsort(-bad[chosen], kind="stable")]
        negative = np.unique(np.concatenate((rng.choice(clean, min(len(clean), NEGATIVES), replace=False), hard))) if len(clean) else clean
        some = np.unique(np.concatenate((top[: LANDMARKS // 2], rng.choice(negative, min(len(negative), LANDMARKS // 4), replace=False), hard[: LANDMARKS // 4])))
        marks = _vectors([spell(i) for i in some])
        gram, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
        keep = gram > 1e-5 * gram.max()
        root = vectors[:, keep] / np.sqrt(gram[keep])
        both = np.concatenate((chosen, negative))
        y = np.where(np.arange(len(both)) < len(chosen), 1.0, -1.0)
        share = np.concatenate((np.sqrt(bad[chosen] + 1.0), np.ones(len(negative))))
        cost = np.where(y > 0, 2000 * share / share[y > 0].sum(), 4000 * share / max(1.0, share[y < 0].sum()))
        w, bias = _svm(_kernel([spell(i) for i in both], marks) @ root, y, cost)
        weights = ((root @ w) @ marks).astype(np.float64)
        value = margins(letters, sizes, weights, bias)
        hard = clean[np.argsort(-value[clean], kind="stable")[: NEGATIVES // 2]]
        explained = np.zeros(len(texts), bool)
        np.logical_or.at(explained, owner, telling[word] | (value[word] > 0))
        open_pairs = mine[~explained[owner[mine]] & (good[word[mine]] == 0)]
        if len(open_pairs):
            order = open_pairs[np.lexsort((value[word[open_pairs]], owner[open_pairs]))]
            last = np.append(np.flatnonzero(owner[order][1:] != owner[order][:-1]), len(order) - 1)
            best = word[order[last]]
            telling[best[value[best] > -0.5]] = True
    best = np.full(len(texts), min(-1.0, bias))
    np.maximum.at(best, owner, value[word])
    return Model(weights, bias, *_line(best, toxic))


def _line(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the labels on the margin, lightly held in."""
    x, w = np.column_stack((margin, np.ones(len(margin)))), np.array([2.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (p - label) + 1e-2 * (w - [2.0, 0.0]))
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0.1)), float(w[1])


def train(docs: DataFrame, labels: DataFrame, learns: Column, sample: int = SAMPLE) -> Model:
    """Fits on at most `sample` rows of each class, those of smallest hash of the id; the sample's bound is the parameter.

    `learns` says, over doc_id, which rows may teach. A document with several label rows counts as toxic if any says so; null labels and
    ids, and labels without a document, teach nothing.
    """
    named = labels.filter("toxic is not null and doc_id is not null").filter(learns).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    key = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = named.filter("_toxic > 0").orderBy(*key).limit(sample).union(named.filter("_toxic <= 0").orderBy(*key).limit(sample))
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "_toxic")  # at most 2 * sample ids
    table = rows.toArrow()
    texts, toxic = text_bytes(table["text"]), table["_toxic"].to_numpy() > 0
    order = sorted(range(len(texts)), key=lambda i: (texts[i], toxic[i]))  # the fit must not depend on the order of arrival
    return fit([texts[i] for i in order], toxic[order])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of a table with `text` and a `toxicity` between 0 and 1 at the end.

    Other columns pass; a column of that name must be renamed first (see `frames.numbered`). Null, empty and wordless texts get the score of a text without a telling word; repeated rows get equal scores; an empty
    table stays empty. Every word of every text is seen.
    """
    at, rows = docs.columns.index("text"), numbered(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(at))
            found = [model.scores(texts[part]) for part in slices(texts)]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "toxicity"])

    scored = rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("toxicity", T.DoubleType())]))
    return scored.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)], "toxicity")
