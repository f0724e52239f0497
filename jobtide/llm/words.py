"""Words of whole texts as 64-bit hashes, computed with arrays.

A word is a run of bytes other than the six ASCII blanks. Hashes are computed over bounded
segments of the joined texts, so that one very long text needs no more memory than many short ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_ODD = np.uint64(0x9E3779B97F4A7C15)
SEGMENT = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Hasher:
    """Word hashes of texts; keeps its tables of powers between calls."""

    def __init__(self) -> None:
        self.up, self.down = _powers(1024)
        self.blank = np.zeros(256, bool)
        self.blank[[32, 9, 10, 11, 12, 13]] = True

    def _cuts(self, data: bytes) -> Iterator[tuple[int, int]]:
        at, blanks = 0, (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")
        while at < len(data):
            end = at + SEGMENT
            if end < len(data):
                found = [p for p in (data.find(x, end, end + 4096) for x in blanks) if p >= 0]
                if not found:
                    found = [p for p in (data.find(x, end) for x in blanks) if p >= 0]
                end = min(found) + 1 if found else len(data)
            end = min(end, len(data))
            yield at, end
            at = end

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and hash of each word of the bytes."""
        starts, ends, hashes = [], [], []
        for a, b in self._cuts(data):
            part = np.frombuffer(data, np.uint8, b - a, a)
            if b - a + 1 > len(self.up):
                self.up, self.down = _powers(max(b - a + 1, SEGMENT + 4097))
            edge = np.diff(np.concatenate(([True], self.blank[part], [True])).astype(np.int8))
            first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self.up[: b - a], out=sums[1:])
            hashes.append(mix((sums[last] - sums[first]) * self.down[first]))
            starts.append(first + a)
            ends.append(last + a)
        if not starts:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0, np.uint64)
        return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)

    def documents(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The joined bytes; start, end and hash of each word; and where each text's words begin (one more at the end)."""
        data = b"\n".join(texts)
        first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        starts, ends, hashes = self.words(data)
        return data, starts, ends, hashes, np.searchsorted(starts, first)


def window_hashes(hashes: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of `width` hashes, one per start."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, base = np.zeros(n, np.uint64), np.uint64((_BASE ^ (salt * 0x5851F42D4C957F2E)) | 1)
    for k in range(width):  # Horner's rule, all starts at once
        out *= base
        out += hashes[k : k + n]
    return mix(out ^ np.uint64(salt))


_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (  # fixed values of the published hash
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxh64_spans(data: bytes, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """The XXH64 of each span of the bytes; spans under 32 bytes are hashed as arrays, longer ones one by one."""
    import xxhash

    out, size = np.empty(len(starts), np.uint64), ends - starts
    short, long = np.flatnonzero(size < 32), np.flatnonzero(size >= 32)
    digest = xxhash.xxh64_intdigest
    if len(long):
        out[long] = np.array([digest(data[a:b], seed) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)], np.uint64)
    raw = np.frombuffer(data + bytes(8), np.uint8)
    eight = np.ndarray(len(data) + 1, np.dtype("<u8"), raw, strides=(1,))
    four = np.ndarray(len(data) + 1, np.dtype("<u4"), raw, strides=(1,))
    for lo in range(0, len(short), 1 << 15):
        pick = short[lo : lo + (1 << 15)]
        pick = pick[np.argsort(size[pick], kind="stable")]
        at, left = starts[pick].copy(), size[pick].copy()
        acc = np.uint64(seed & (2**64 - 1)) + _P5 + left.astype(np.uint64)
        for _ in range(3):  # whole lanes; spans are in order of size, so those that go on are a tail
            k = np.searchsorted(size[pick], 8 * (_ + 1))
            if k == len(pick):
                break
            lane = _turn(eight[at[k:]] * _P2, 31) * _P1
            acc[k:] = _turn(acc[k:] ^ lane, 27) * _P1 + _P4
            at[k:] += 8
            left[k:] -= 8
        k = np.flatnonzero(left >= 4)
        acc[k] = _turn(acc[k] ^ (four[at[k]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at[k] += 4
        left[k] -= 4
        for _ in range(3):
            k = np.flatnonzero(left > _)
            acc[k] = _turn(acc[k] ^ (raw[at[k]].astype(np.uint64) * _P5), 11) * _P1
            at[k] += 1
        acc = (acc ^ (acc >> np.uint64(33))) * _P2
        acc = (acc ^ (acc >> np.uint64(29))) * _P3
        out[pick] = acc ^ (acc >> np.uint64(32))
    return out
