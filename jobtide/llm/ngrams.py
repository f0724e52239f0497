"""Language-model scores from an n-gram trie of reversed contexts, spread over buckets of last context words."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_path
from . import blocks
from .eliasfano import EliasFano
from .words import Hasher, mix, text_bytes

ORDER, PRIOR = 3, 8.0
END = np.uint64(0x5851F42D4C957F2D)  # the end mark, beside all word hashes
BLOCK_BYTES = 8 << 20
STEPS, LACKING = 36.0, 65535  # steps of a quantised log10 probability (two bytes: below any count's share), and the code of what a trie lacks
ADD = 0.1


def quantised(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-np.log10(p) * STEPS), LACKING - 1).astype(np.uint16)


def unquantised(codes: np.ndarray) -> np.ndarray:
    """The probabilities; zero for what a trie lacks."""
    by_code = np.append(10.0 ** (np.arange(LACKING, dtype=np.float64) / -STEPS), 0.0)
    return by_code[codes]


def _firsts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.ones(len(sorted_keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    return np.flatnonzero(new)


def _runs(first: np.ndarray, n: int) -> np.ndarray:
    """The run of each of n places."""
    return np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))


def _joined(places: np.ndarray, words: np.ndarray, bits: int) -> np.ndarray:
    """Places and words below them as single keys in the same order."""
    out = places.astype(np.uint64)
    out <<= np.uint64(bits)
    out |= words.astype(np.uint64, copy=False)
    return out


def _different(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different key, in order of the keys; and which of them each place has."""
    order = np.argsort(keys)
    first = _firsts(keys[order])
    where = np.empty(len(order), np.int32)
    where[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(order))))
    return order[first], where


class Children:
    """One level of the trie: what hangs below each node of the level above, in order, with a code each.

    A child's word is stored relative to its parent, after the parent's number: so all children are one monotone sequence, and a word is
    sought as a successor inside the range that the parent's pointers name.
    """

    def __init__(self, parents: np.ndarray, n_parents: int, words: np.ndarray, codes: np.ndarray, word_bits: int) -> None:
        self.bits = np.uint64(word_bits)
        first = np.searchsorted(parents, np.arange(n_parents + 1)).astype(np.uint64)
        self.sequences = [EliasFano.of(first, max(1, len(words)).bit_length() + 1),
                          EliasFano.of(_joined(parents, words, word_bits), word_bits + max(1, n_parents).bit_length())]
        self.codes = codes

    def arrays(self) -> list[np.ndarray]:
        return [*(a for s in self.sequences for a in (s.upper, s.lower)), self.codes]

    def mapped(self, views: list[np.ndarray]) -> None:
        self.sequences = [EliasFano(s.n, s.low, views[2 * i], views[2 * i + 1]) for i, s in enumerate(self.sequences)]
        self.codes = views[4]

    def find(self, parents: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The places of words below nodes (-1: no such node), -1 where there is none. Parents ascend."""
        out = np.full(len(parents), -1, np.int64)
        pointers, children = self.sequences
        have = np.flatnonzero(parents >= 0)
        if not len(have) or not children.n:
            return out
        mine = parents[have]
        first = _firsts(mine)
        end = pointers.get(mine[first] + 1).astype(np.int64)[_runs(first, len(mine))]
        wanted = (mine.astype(np.uint64) << self.bits) | words[have]
        place, ok = children.seek(wanted)
        ok &= place < end
        out[have[ok]] = place[ok]
        return out

    def code(self, places: np.ndarray) -> np.ndarray:
        out = np.full(len(places), LACKING, np.uint16)
        out[places >= 0] = self.codes[places[places >= 0]]
        return out


class Trie:
    """A bucket's grams by reversed context, in one memory-mapped file of Elias-Fano sequences.

    The root holds the last context words. Below each are the words before it (`longer`), whose codes say what a context leaves to the
    shorter one, and the words after it (`after`). Below each longer context are the words after that (`after_longer`). Codes of
    words after a context are their count over the context's count and the prior.
    """

    def __init__(self, last: np.ndarray, before: np.ndarray, word: np.ndarray, count: np.ndarray, prior: float, bits: int, folder: str,
                 known: dict[int, int] | None = None) -> None:
        """Of training grams (last context word, the one before it, the word), each once and in order.

        `known` has the counts of last context words whose grams are not all here.
        """
        roots, nodes = _firsts(last), _firsts(last, before)
        root, node = _runs(roots, len(last)), _runs(nodes, len(last))
        held = np.add.reduceat(count, nodes) if len(nodes) else count
        keys = _joined(root, word, bits)
        order = np.argsort(keys)
        pairs = _firsts(keys[order])
        both = np.add.reduceat(count[order], pairs) if len(pairs) else count
        of, total = root[order[pairs]], np.add.reduceat(count, roots) if len(roots) else count
        if known is not None:
            total = np.array([known[x] for x in last[roots].tolist()], np.int64)
        self.roots = EliasFano.of(last[roots], bits)
        self.longer = Children(root[nodes], len(roots), before[nodes], quantised(prior / (held + prior)), bits)
        self.after = Children(of, len(roots), word[order[pairs]], quantised(both / (total[of] + prior)), bits)
        self.after_longer = Children(node, len(nodes), word, quantised(count / (held[node] + prior)), bits)
        levels = [self.longer, self.after, self.after_longer]
        arrays = [self.roots.upper, self.roots.lower, *(a for level in levels for a in level.arrays())]
        path = os.path.join(folder, "trie")
        with open(path, "wb") as out:
            for array in arrays:
                raw = np.ascontiguousarray(array).tobytes()
                out.write(raw + bytes(-len(raw) % 8))
            out.write(bytes(8))
        file, at, views = np.asarray(np.memmap(path, np.uint8, "r")), 0, []
        for array in arrays:
            views.append(file[at : at + array.nbytes].view(array.dtype))
            at += array.nbytes + -array.nbytes % 8
        self.roots = EliasFano(self.roots.n, self.roots.low, views[0], views[1])
        for i, level in enumerate(levels):
            level.mapped(views[2 + 5 * i : 7 + 5 * i])

    def root(self, words: np.ndarray) -> np.ndarray:
        """The nodes of last context words, -1 where there is none."""
        place, same = self.roots.seek(words)
        return np.where(same, place, -1)


def _planes(numbers: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones, compressed; small numbers take little room."""
    raw = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.itemsize).T.tobytes()
    packed = pa.compress(raw, codec="zstd", asbytes=True)
    return np.array([len(numbers), len(packed)], "<u4").tobytes() + packed


def _read_planes(data: bytes, at: int, *kinds: str) -> tuple[list[np.ndarray], int]:
    """Consecutive pieces, and where the next one begins."""
    out = []
    for kind in kinds:
        n, length = np.frombuffer(data, "<u4", 2, at).tolist()
        size, at = np.dtype(kind).itemsize, at + 8
        raw = pa.decompress(data[at : at + length], decompressed_size=n * size, codec="zstd", asbytes=True)
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).reshape(n))
        at += length
    return out, at


def _steps(hashes: np.ndarray) -> np.ndarray:
    """Sorted hashes as the first and the distances between them, which have fewer bits."""
    return np.diff(hashes.astype("<u8"), prepend=np.zeros(1, "<u8"))


def _from_steps(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype="<u8")


_NOTHING = bytes(4)


class Grams:
    """Grams (last context word, the one before it, the word, training count) in order, as they travel: every context once."""

    def __init__(self, last: np.ndarray, before: np.ndarray, word: np.ndarray, count: np.ndarray) -> None:
        first = _firsts(last, before)
        self._hold(last[first], before[first], np.diff(np.append(first, len(last))), word, count)

    @classmethod
    def of(cls, *held: np.ndarray) -> Grams:
        """Of different contexts (last word, the one before), the number of words after each, the words and their counts."""
        out = cls.__new__(cls)
        out._hold(*held)
        return out

    def _hold(self, context_last: np.ndarray, context_before: np.ndarray, sizes: np.ndarray, word: np.ndarray, count: np.ndarray) -> None:
        self.context_last, self.context_before, self.sizes, self.word, self.count = context_last, context_before, sizes, word, count
        self.roots = _firsts(context_last)  # among the contexts

    @property
    def last(self) -> np.ndarray:
        return np.repeat(self.context_last, self.sizes)

    @property
    def before(self) -> np.ndarray:
        return np.repeat(self.context_before, self.sizes)

    def contexts(self) -> np.ndarray:
        """The context of each gram."""
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def pack(self) -> bytes:
        if not len(self.word):
            return _NOTHING
        return b"".join(_planes(x) for x in (
            self.context_last[self.roots].astype("<u8"), np.diff(np.append(self.roots, len(self.sizes))).astype("<u4"),
            self.context_before.astype("<u8"), self.sizes.astype("<u4"), self.word.astype("<u8"), self.count.astype("<u4")))

    @classmethod
    def unpack(cls, data: bytes, at: int = 0) -> tuple[Grams, int]:
        if data[at : at + 4] == _NOTHING:
            return NO_GRAMS, at + 4
        (last, nodes, before, sizes, word, count), at = _read_planes(data, at, "<u8", "<u4", "<u8", "<u4", "<u8", "<u4")
        return cls.of(np.repeat(last, nodes), before, sizes, word, count), at

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """One gram of each (last context word, word), in order of both; and which of them each gram has."""
        return _pairs(_runs(self.roots, len(self.sizes))[self.contexts()], self.word)


def _pairs(root: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each pair, in order, and the pair of each place."""
    return _different(_joined(root, word, int(word.max()).bit_length() if len(word) else 0))


NO_GRAMS = Grams(*[np.zeros(0, kind) for kind in ("<u8", "<u8", "<u8", "<u4")])


def _together(questions: list[Grams], bits: int) -> tuple[Grams, np.ndarray, np.ndarray]:
    """All different grams with their counts added up; and which of their contexts, and which of them, the questions' have in turn."""
    width, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    lasts, root = np.unique(np.concatenate([q.context_last for q in questions]), return_inverse=True)
    keys = _joined(root, np.concatenate([q.context_before for q in questions]), bits)
    one, node = _different(keys)
    contexts = keys[one]
    keys = _joined(np.repeat(node, np.concatenate([q.sizes for q in questions])), np.concatenate([q.word for q in questions]), bits)
    one, gram = _different(keys)
    keys = keys[one]
    count = np.bincount(gram, weights=np.concatenate([q.count for q in questions]), minlength=len(keys)).astype(np.int64)
    sizes = np.bincount((keys >> width).astype(np.int64), minlength=len(contexts))
    return Grams.of(lasts[(contexts >> width).astype(np.int64)], contexts & mask, sizes, keys & mask, count), node, gram


def _count_words(payloads: list[bytes]) -> list[bytes]:
    """Adds up the training counts of each word and tells each block the counts of its words and their numbers; last the bucket's totals.

    Numbers are given by falling count, so that those of frequent words are small; counts travel in the order of the numbers, in which they fall. Totals are the training tokens, the different ones,
    and all different tokens.
    """
    parts = [(_from_steps(steps), count) for (steps, count), _ in (_read_planes(p, 0, "<u8", "<u4") for p in payloads)]
    words, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.bincount(where, weights=np.concatenate([p[1] for p in parts]), minlength=len(words)).astype(np.int64)
    number = np.empty(len(words), "<u4")
    number[np.argsort(-counts, kind="stable")] = np.arange(len(words))
    out, at = [], 0
    for hashes, _ in parts:
        here = where[at : at + len(hashes)]
        mine = number[here]
        out.append(_planes(counts[here][np.argsort(mine)].astype("<i8")) + _planes(mine))
        at += len(here)
    return [*out, np.array([counts.sum(), (counts > 0).sum(), len(words)], ">i8").tobytes()]


class _Found:
    """The codes that a trie has for grams: of their contexts, of themselves and of their pairs, as far as this kind of question has them."""

    def __init__(self, trie: Trie, grams: Grams, kind: int) -> None:
        self.kind, context = kind, grams.contexts()
        root = trie.root(grams.context_last[grams.roots])[_runs(grams.roots, len(grams.sizes))]
        if kind < 2:
            node = trie.longer.find(root, grams.context_before)
            self.longer, self.gram = trie.longer.code(node), trie.after_longer.code(trie.after_longer.find(node[context], grams.word))
        if kind != 1:
            pairs, self.of_pair = grams.pairs()
            self.pair = trie.after.code(trie.after.find(root[context[pairs]], grams.word[pairs]))

    def reply(self, contexts: np.ndarray, grams: np.ndarray) -> bytes:
        """To a question that has these contexts and grams."""
        if not len(grams):
            return b""
        out = _planes(self.longer[contexts]) + _planes(self.gram[grams]) if self.kind < 2 else b""
        if self.kind != 1:
            pairs = np.sort(self.of_pair[grams])
            out += _planes(self.pair[pairs[_firsts(pairs)]])
        return out


def _look_up(trie: Trie, grams: Grams, kind: int) -> bytes:
    """The codes of a question by itself."""
    return _Found(trie, grams, kind).reply(np.arange(len(grams.sizes)), np.arange(len(grams.word)))


def _answer_grams(prior: float, bits: int):
    """Builds a bucket's tries from all blocks' training counts and looks up the blocks' grams in them, those of several blocks once.

    A question has three kinds of grams, and each has its trie: those whose last context word is the bucket's; those whose whole context
    is, as the last word is too frequent for one bucket; and pairs that are, for the same reason, with the counts of their contexts.
    """
    def answer(payloads: list[bytes]) -> list[bytes]:
        read, known, replies = [0] * len(payloads), {}, [[] for _ in payloads]
        for kind in range(3):
            questions = []
            for i, payload in enumerate(payloads):
                grams, read[i] = Grams.unpack(payload, read[i])
                questions.append(grams)
                if kind == 2 and len(grams.word):
                    (counts,), _ = _read_planes(payload, read[i], "<i8")
                    known.update(zip(grams.context_last[grams.roots].tolist(), counts.tolist(), strict=True))
            if not any(len(q.word) for q in questions):
                continue
            ends = np.cumsum([[len(q.sizes), len(q.word)] for q in questions], axis=0)[:-1].T
            grams, contexts, places = _together(questions, bits)
            questions.clear()
            taught = np.flatnonzero(grams.count)
            with tempfile.TemporaryDirectory() as folder:
                trie = Trie(*(x[taught] for x in (grams.last, grams.before, grams.word, grams.count)), prior, bits, folder, known if kind == 2 else None)
                found = _Found(trie, grams, kind)
                del trie
            for reply, *mine in zip(replies, np.split(contexts, ends[0]), np.split(places, ends[1]), strict=True):
                reply.append(found.reply(*mine))
        return [b"".join(r) for r in replies]

    return answer


class _Block:
    """A block's tokens as numbers of its different words, and how many each text has; an end mark closes each text."""

    def __init__(self, n: np.ndarray, where: np.ndarray, words: np.ndarray, held: np.ndarray) -> None:
        self.n, self.where, self.words = n.astype(np.int64), where.astype(np.int64), words
        self.owner = np.repeat(np.arange(len(n)), self.n)
        self.trains = ~held[self.owner]

    @classmethod
    def of(cls, texts: list[bytes], held: np.ndarray) -> _Block:
        _, _, _, hashes, first = Hasher().documents([t.lower() for t in texts])
        words, where = np.unique(np.insert(hashes, first[1:], END), return_inverse=True)
        return cls(np.diff(first) + 1, where, words, held)

    def pack(self) -> bytes:
        return _planes(self.n.astype("<u8")) + _planes(self.where.astype("<u4")) + _planes(_steps(self.words))

    @classmethod
    def unpack(cls, data: bytes, held: np.ndarray) -> _Block:
        n, where, steps = _read_planes(data, 0, "<u8", "<u4", "<u8")[0]
        return cls(n, where, _from_steps(steps), held)


class _Asked:
    """The different grams of a block, and the buckets that are asked about them.

    `counts` and `ids` are those of the block's words. Words take the order of their ids, so that grams in order of their words are in
    order of their ids for every bucket.
    """

    def __init__(self, block: _Block, counts: np.ndarray, ids: np.ndarray, order: int, buckets: int, hot: float) -> None:
        rank = np.empty(len(ids), np.int64)
        by_id = np.argsort(ids)
        rank[by_id] = np.arange(len(ids))
        self.ids, self.counts = ids[by_id], counts[by_id]
        token = rank[block.where]
        place = np.arange(len(token)) - np.repeat(np.cumsum(block.n) - block.n, block.n)
        end = rank[np.searchsorted(block.words, END)] if len(block.words) else 0
        last = np.where(place > 0, np.roll(token, 1), end)
        before = np.where(place > 1, np.roll(token, 2), end) + 1 if order > 2 else np.zeros(len(token), np.int64)
        before[place == 0] = 0  # nothing stands before a text's end mark
        width = max(1, int(len(ids)).bit_length() + 1)
        if 3 * width < 64:
            different, self.back = np.unique((last << 2 * width) | (before << width) | token, return_inverse=True)
            mask = (1 << width) - 1
            self.last, self.before, self.word = different >> 2 * width, (different >> width) & mask, different & mask
        else:  # very many words in one text
            sort = np.lexsort((token, before, last))
            first = _firsts(last[sort], before[sort], token[sort])
            self.back = np.empty(len(token), np.int64)
            self.back[sort] = _runs(first, len(sort))
            self.last, self.before, self.word = last[sort][first], before[sort][first], token[sort][first]
        self.taught = np.bincount(self.back, weights=block.trains, minlength=len(self.last)).astype(np.int64)
        frequent = self.counts[self.last] > hot if len(self.last) else np.zeros(0, bool)
        seen = mix(self.ids.astype(np.uint64) ^ np.uint64(buckets))
        with_before = np.concatenate((np.zeros(1, np.uint64), seen))
        self.kinds = [self._dealt(np.flatnonzero(~frequent), seen[self.last[~frequent]], buckets)]
        hard = np.flatnonzero(frequent)
        self.kinds.append(self._dealt(hard, mix(seen[self.last[hard]] + with_before[self.before[hard]]), buckets))
        one, self.hard_pair = _pairs(self.last[hard], self.word[hard])
        self.pair = hard[one]  # a gram of each frequent pair
        self.pair_taught = np.zeros(len(self.last), np.int64)
        self.pair_taught[self.pair] = np.bincount(self.hard_pair, weights=self.taught[hard], minlength=len(one))
        self.kinds.append(self._dealt(self.pair, mix(mix(seen[self.last[self.pair]]) + seen[self.word[self.pair]]), buckets))
        self.seen, self.buckets, self.frequent, self.hard = seen, buckets, frequent, hard

    @staticmethod
    def _dealt(at: np.ndarray, hashes: np.ndarray, buckets: int) -> list[np.ndarray]:
        """The places for each bucket, in order."""
        bucket = ((hashes >> np.uint64(16)) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.uint32)  # two bytes are sorted fast
        sort = np.argsort(bucket, kind="stable")
        return [at[x] for x in np.split(sort, np.searchsorted(bucket[sort], np.arange(1, buckets)))]

    def grams(self, bucket: int, kind: int) -> Grams:
        at = self.kinds[kind][bucket]
        last, before = self.last[at], self.before[at] if kind < 2 else np.zeros(len(at), np.int64)
        first = _firsts(last, before)
        before = before[first]
        before = np.where(before > 0, self.ids[np.maximum(before - 1, 0)] + 1, 0)
        return Grams.of(self.ids[last[first]], before, np.diff(np.append(first, len(at))), self.ids[self.word[at]], (self.taught if kind < 2 else self.pair_taught)[at])

    def question(self, bucket: int) -> bytes:
        kinds = [self.grams(bucket, kind) for kind in range(3)]
        at = self.kinds[2][bucket]
        known = self.counts[self.last[at][_firsts(self.last[at])]].astype("<i8")
        return b"".join(g.pack() for g in kinds) + (_planes(known) if len(at) else b"")

    def probabilities(self, replies: dict[int, bytes], total: int, norm: float, prior: float, order: int) -> np.ndarray:
        """The probability of each different gram's word."""
        p = (self.counts[self.word] + ADD) / norm
        if order == 1:
            return p
        n = len(self.last)
        codes = np.full((3, n), LACKING, np.uint16)  # of the longer contexts, the grams, and the pairs at their grams
        easy = np.flatnonzero(~self.frequent)
        one, easy_pair = _pairs(self.last[easy], self.word[easy])
        easy_at = easy[one]
        pairs = self._dealt(easy_at, self.seen[self.last[easy_at]], self.buckets)
        for bucket, data in replies.items():
            at = 0
            for kind in range(3):
                mine = self.kinds[kind][bucket]
                if not len(mine):
                    continue
                if kind < 2:
                    (longer, gram), at = _read_planes(data, at, "<u2", "<u2")
                    codes[0, mine], codes[1, mine] = longer[_runs(_firsts(self.last[mine], self.before[mine]), len(mine))], gram
                if kind != 1:
                    (code,), at = _read_planes(data, at, "<u2")
                    codes[2, pairs[bucket] if kind == 0 else mine] = code
        after = np.empty(n)
        after[easy], after[self.hard] = unquantised(codes[2, easy_at])[easy_pair], unquantised(codes[2, self.pair])[self.hard_pair]
        p = after + prior / (self.counts[self.last] + prior) * p
        if order > 2:
            rest = np.where(codes[0] == LACKING, 1.0, unquantised(codes[0]))
            p = np.where(self.before > 0, unquantised(codes[1]) + rest * p, p)
        return p


def _totals(said: DataFrame) -> tuple[int, int, int]:
    """Training tokens and different ones, both summed over the buckets, and the different tokens of the largest bucket."""
    at = lambda i: F.conv(F.hex(F.substring("reply", 1 + 8 * i, 8)), 16, 10).cast("long")
    found = said.filter("_block < 0").agg(F.sum(at(0)), F.sum(at(1)), F.max(at(2))).first()
    return tuple(x or 0 for x in found)


STORED = "part int, _block long, _bucket int, payload binary"


def score(docs: DataFrame, held_out: Column, order: int = ORDER, prior: float = PRIOR, block_bytes: int = BLOCK_BYTES,
          direct: int = blocks.DIRECT) -> DataFrame:
    """Each text's log10 probability under an n-gram model (order 1 to 3) of the rows that are not held out.

    Unigrams have additive smoothing; each higher order mixes its counts with the order below by a Dirichlet prior:
    p(w | h) = (c(h w) + prior * p(w | shorter h)) / (c(h) + prior). Counts cover all training rows and are never pruned.

    Blocks of documents are tokenised once and stored. They ask buckets of words for counts and numbers; then one question and one
    answer serve all orders: a gram goes to the bucket of its last context word, which holds that part of the trie, memory-mapped, and
    answers with quantised probabilities. The grams of a word with more than a bucket's fair share of the tokens are dealt over all
    buckets by their whole contexts, and its pairs by themselves. With more than `direct` buckets the exchange takes two steps (see `blocks`).

    Needs `doc_id` and `text`; other columns are ignored. A null, empty or blank text is the end mark alone; a null
    `held_out` counts as training; repeated rows count and are scored each; an empty table gives no rows, and with no
    training token every word has the same probability. Returns doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (unigrams alone) and score.
    """
    if order not in (1, 2, 3):
        raise ValueError("order must be 1, 2 or 3")
    spark, picked = docs.sparkSession, docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    buckets = blocks.buckets_for(docs, "text", block_bytes)
    rack = blocks.rack_size(buckets, direct)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, parts in blocks.cut(batches, 1, block_bytes):
            table = pa.Table.from_batches(parts)
            held = table["held_out"].to_numpy(zero_copy_only=False).astype(bool)
            block = _Block.of(text_bytes(table["text"]), held)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.select(["doc_id", "held_out"]).schema) as out:
                out.write_table(table.select(["doc_id", "held_out"]))
            rows = sink.getvalue().to_pybytes()
            counts = np.bincount(block.where, weights=block.trains, minlength=len(block.words))
            out = [(0, number, -1, np.array([len(rows)], "<u8").tobytes() + rows + block.pack())]
            asked = blocks.asked([(bucket, number, _planes(_steps(block.words[at])) + _planes(counts[at].astype("<u4")))
                                  for bucket, at in enumerate(blocks.by_bucket(block.words, buckets)) if len(at)], rack)
            out += list(zip([1] * asked.num_rows, *(asked[c].to_pylist() for c in ("_block", "_bucket", "payload")), strict=True))
            for row in out:  # each is large
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int64(), pa.int32(), pa.binary()), strict=True)],
                                                 names=["part", "_block", "_bucket", "payload"])
            blocks.release()

    path = work_path(spark, "lm")
    picked.mapInArrow(tokenise, STORED).write.partitionBy("part").parquet(f"{path}/blocks")
    stored = spark.read.schema("_block long, _bucket int, payload binary, part int").parquet(f"{path}/blocks")
    asked = stored.filter("part = 1").select("_bucket", "_block", "payload")
    blocks.answered(asked, _count_words, buckets, rack, totals=True).write.parquet(f"{path}/words")
    words = spark.read.schema(blocks.ANSWER).parquet(f"{path}/words")
    total, different, widest = _totals(words)
    norm, hot = total + ADD * (different + 1), total / (4 * buckets)
    words = blocks.delivered(words.filter("_block >= 0"), rack).select("_block", F.lit(0).alias("part"), "_bucket", "reply")
    bits = (buckets * (widest + 1) + 1).bit_length()  # of a word's id, and of one more

    def opened(table: pa.Table, said: pa.Table) -> tuple[pa.Table, _Block, _Asked, dict[int, bytes]]:
        blocks.release()
        payload = table["payload"][0].as_buffer().to_pybytes()
        size = int(np.frombuffer(payload, "<u8", 1)[0])
        rows = pa.ipc.open_stream(payload[8 : 8 + size]).read_all()
        block = _Block.unpack(payload[8 + size :], rows["held_out"].to_numpy(zero_copy_only=False).astype(bool))
        heard = [blocks.replies(said.filter(pc.equal(said["part"], part)), rack) for part in (0, 1)]
        counts, ids = np.zeros(len(block.words), np.int64), np.zeros(len(block.words), np.int64)
        for bucket, at in enumerate(blocks.by_bucket(block.words, buckets)):
            if len(at):
                (falling, number), _ = _read_planes(heard[0][bucket], 0, "<i8", "<u4")
                counts[at[np.argsort(number)]] = falling
                ids[at] = number.astype(np.int64) * buckets + bucket
        return rows, block, _Asked(block, counts, ids, order, buckets, hot), heard[1]

    def ask(key: tuple, table: pa.Table, said: pa.Table) -> pa.Table:
        if not table.num_rows:
            return blocks.asked([])
        _, _, asked, _ = opened(table, said)
        return blocks.asked([(bucket, key[0].as_py(), asked.question(bucket)) for bucket in range(buckets) if any(len(kind[bucket]) for kind in asked.kinds)], rack)

    def finish(key: tuple, table: pa.Table, said: pa.Table) -> pa.Table:
        if not table.num_rows:
            return out_schema.empty_table()
        rows, block, asked, replies = opened(table, said)
        p, n = np.log10(asked.probabilities(replies, total, norm, prior, order)), len(block.n)
        known = asked.counts[asked.word]
        add = lambda x: np.bincount(block.owner, weights=x[asked.back], minlength=n)
        return pa.Table.from_arrays([rows["doc_id"], rows["held_out"], pa.array(block.n), pa.array(add(known > 0).astype(np.int64)),
                                     pa.array(np.full(n, total, np.int64)), pa.array(add(np.log10((known + ADD) / norm))), pa.array(add(p))], schema=out_schema)

    schema = T.StructType([docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()), *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")),
                           T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    out_schema = _arrow(schema)
    by_block = stored.filter("part = 0").select("_block", "payload").repartition("_block").groupBy("_block")
    said = words
    if order > 1:
        questions = by_block.cogroup(words.groupBy("_block")).applyInArrow(ask, blocks.ASK)
        grams = blocks.answers(questions, _answer_grams(prior, bits), buckets, rack)
        said = words.unionByName(grams.select("_block", F.lit(1).alias("part"), "_bucket", "reply"))
    return by_block.cogroup(said.groupBy("_block")).applyInArrow(finish, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
