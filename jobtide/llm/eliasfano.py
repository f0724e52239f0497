"""Monotone sequences in Elias-Fano form, readable from a memory-mapped file."""

from __future__ import annotations

import numpy as np

_WORD = 64  # bits of the upper halves between two directory entries
_PART, _NEAR = 1 << 16, 32  # places sought at a time, and up to how many bits (or an eighth as many numbers) each are unpacked for them


def _pick(words: np.ndarray, before: np.ndarray, k: np.ndarray, one: bool) -> np.ndarray:
    """Places of the k-th ones (or zeros): the directory gives the word, halving gives the bit.

    Where the words between the first and the last are few for the places sought, all their bits are unpacked.
    """
    out = np.empty(len(k), np.int64)
    for at in range(0, len(k), _PART):
        part = k[at : at + _PART]
        first, last = (np.searchsorted(before, (part.min(), part.max()), "right") - 1).tolist()
        if (last + 1 - first) * _WORD <= _NEAR * len(part):
            near = words[first : last + 1] if one else ~words[first : last + 1]
            bits = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little"))
            out[at : at + _PART] = first * _WORD + bits[part - before[first]]
            continue
        block = np.searchsorted(before, part, "right") - 1
        left = (part - before[block]).astype(np.uint8)
        word = words[block] if one else ~words[block]
        bit = np.zeros(len(part), np.uint64)
        for half in (32, 16, 8, 4, 2, 1):
            have = np.bitwise_count((word >> bit) & np.uint64((1 << half) - 1))
            beyond = left >= have
            left -= have * beyond
            bit += beyond * np.uint64(half)
        out[at : at + _PART] = block * _WORD + bit.astype(np.int64)
    return out


class EliasFano:
    """n non-decreasing numbers below 2^bits: the upper halves in unary, the lower ones packed."""

    def __init__(self, n: int, low: int, upper: np.ndarray, lower: np.ndarray) -> None:
        self.n, self.low, self.upper, self.lower = n, low, upper, lower
        self.words = upper.view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.ones = np.cumsum(ones) - ones
        self.zeros = np.arange(len(ones)) * _WORD - self.ones

    @classmethod
    def of(cls, values: np.ndarray, bits: int) -> EliasFano:
        n = len(values)
        low = max(0, bits - max(1, n).bit_length())
        high = (values >> np.uint64(low)).astype(np.int64)
        size = n + (int(high[-1]) if n else 0) + 2
        size += -size % _WORD  # whole words; the rest is zeros
        unary = np.zeros(size, np.uint8)
        unary[high + np.arange(n)] = 1
        rest = values & np.uint64((1 << low) - 1)
        words = np.zeros(n * low // 64 + 2, np.uint64)
        at = np.arange(n, dtype=np.int64) * low
        np.bitwise_or.at(words, at >> 6, rest << (at & 63).astype(np.uint64))
        over = (at & 63) + low > 64
        np.bitwise_or.at(words, (at[over] >> 6) + 1, rest[over] >> (64 - (at[over] & 63)).astype(np.uint64))
        return cls(n, low, np.packbits(unary, bitorder="little"), words)

    def _lower(self, i: np.ndarray) -> np.ndarray:
        at = i * self.low
        shift = (at & 63).astype(np.uint64)
        got = self.lower[at >> 6] >> shift
        over = (at & 63) + self.low > 64
        got[over] |= self.lower[(at[over] >> 6) + 1] << (np.uint64(64) - shift[over])
        return got & np.uint64((1 << self.low) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The numbers at these places."""
        if not len(i):
            return np.zeros(0, np.uint64)
        high = (_pick(self.words, self.ones, i, True) - i).astype(np.uint64)
        return (high << np.uint64(self.low)) | self._lower(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The place of the first number that is not below x, n if there is none."""
        return self.seek(x)[0]

    def seek(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The successors' places, and whether they are the numbers themselves. Numbers that ascend are found sooner."""
        out, same = np.full(len(x), self.n, np.int64), np.zeros(len(x), bool)
        high = (x >> np.uint64(self.low)).astype(np.int64)
        top = 8 * len(self.upper) - self.n  # zeros there are
        inside = np.flatnonzero(high < top)
        for at in range(0, len(inside), _PART):
            part = inside[at : at + _PART]
            out[part], same[part] = self._seek(high[part], x[part] & np.uint64((1 << self.low) - 1))
        return out, same

    def _seek(self, high: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = np.zeros(len(high), np.int64)
        some = np.flatnonzero(high > 0)
        begin[some] = _pick(self.words, self.zeros, high[some] - 1, False) - (high[some] - 1)
        beyond = _pick(self.words, self.zeros, high, False) - high
        first, last, lower = int(begin.min()), int(beyond.max()), self._lower
        if 8 * (last - first) <= _NEAR * len(high):  # unpacked once
            near = self._lower(np.arange(first, last))
            lower = lambda i: near[i - first]
        end = beyond.copy()
        go = np.flatnonzero(begin < end)
        while len(go):  # halving among the numbers of equal upper half, which may be many where numbers cluster
            middle = (begin[go] + end[go]) >> 1
            below = lower(middle) < rest[go]
            begin[go[below]] = middle[below] + 1
            end[go[~below]] = middle[~below]
            go = go[begin[go] < end[go]]
        same = begin < beyond
        same[same] = lower(begin[same]) == rest[same]
        return begin, same
