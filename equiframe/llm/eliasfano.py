"""Elias-Fano sequences over mapped files, with array-at-a-time access.

A non-decreasing sequence of n numbers below u keeps the low
l = log2(u / n) bits of each number packed in a row, and the high bits as a
bit vector of n ones and u / 2**l zeros.  Both parts are plain bytes, so a
sequence is read where it lies in a mapped file; only the counts of ones per
``BLOCK`` bytes are held in memory.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 8              # bytes of the bit vector per count
_HEAD = "<QQQQ"        # numbers, low bits, bytes of the low part, bytes of the vector
HEAD_BYTES = struct.calcsize(_HEAD)
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
#: Place of the k-th one in a byte.
_PLACE = np.array([([i for i in range(8) if b >> i & 1] + [8] * 8)[:8] for b in range(256)], np.uint8)


def encode(values: np.ndarray) -> bytes:
    """A non-decreasing array of unsigned 64-bit numbers as bytes."""
    values = values.astype(np.uint64)
    n = len(values)
    top = int(values[-1]) if n else 0
    low_bits = min(56, max(0, (top // n).bit_length() - 1)) if n else 0
    high = (values >> np.uint64(low_bits)).astype(np.int64)
    bits = np.zeros(n + (int(high[-1]) if n else 0) + 1, np.uint8)
    bits[high + np.arange(n)] = 1
    vector = np.packbits(bits, bitorder="little").tobytes()
    if low_bits:
        parts, step, k = [], 1 << 16, np.arange(low_bits, dtype=np.uint64)  # steps end on whole bytes
        for at in range(0, n, step):
            parts.append(np.packbits(((values[at:at + step, None] >> k) & np.uint64(1)).astype(np.uint8).ravel(),
                                     bitorder="little").tobytes())
        low = b"".join(parts)
    else:
        low = b""
    low += bytes(8)  # reads of eight bytes may begin at the last one
    vector += bytes(-len(vector) % BLOCK)
    return struct.pack(_HEAD, n, low_bits, len(low), len(vector)) + low + vector


class Sequence:
    """A sequence encoded in the bytes of ``data`` (uint8) from ``at`` on."""

    def __init__(self, data: np.ndarray, at: int = 0):
        self.n, self.low_bits, low, vector = struct.unpack(_HEAD, data[at:at + HEAD_BYTES].tobytes())
        at += HEAD_BYTES
        self.low, self.vector = data[at:at + low], data[at + low:at + low + vector]
        self.end = at + low + vector
        ones = np.add.reduceat(_ONES[self.vector], np.arange(0, vector, BLOCK)) if vector else np.zeros(0, np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones, dtype=np.int64)])  # before each block
        self.zeros = np.arange(len(self.ones)) * (8 * BLOCK) - self.ones

    def _select(self, k: np.ndarray, counts: np.ndarray, flip: int) -> np.ndarray:
        """Position of the k-th one (zero, if ``flip`` is 255), from 0."""
        block = np.searchsorted(counts, k, "right") - 1
        block = np.minimum(block, len(counts) - 2)
        out = np.empty(len(k), np.int64)
        for a in range(0, len(k), 1 << 16):
            b = block[a:a + (1 << 16)]
            rest = k[a:a + (1 << 16)] - counts[b]
            body = self.vector[(b * BLOCK)[:, None] + np.arange(BLOCK)] ^ np.uint8(flip)
            run = np.cumsum(_ONES[body], 1, dtype=np.int16)
            at = (run <= rest[:, None]).sum(1)
            at = np.minimum(at, BLOCK - 1)
            row = np.arange(len(b))
            before = np.where(at > 0, run[row, at - 1], 0)
            out[a:a + (1 << 16)] = (b * BLOCK + at) * 8 + _PLACE[body[row, at], np.minimum(rest - before, 7)]
        return out

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        words = np.ascontiguousarray(self.low[(bit >> 3)[:, None] + np.arange(8)]).view("<u8").ravel()
        return (words >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The numbers at the places ``i``."""
        high = self._select(i, self.ones, 0) - i
        return (high.astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)

    def _before(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have high bits below ``high``."""
        known = self.zeros[-1]
        h = np.clip(high, 0, known)
        out = self._select(np.maximum(h - 1, 0), self.zeros, 255) - (h - 1)
        return np.where(h <= 0, 0, np.minimum(out, self.n))

    def successor(self, x: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> np.ndarray:
        """The first place in [begin, end) whose number is at least x (end if
        there is none)."""
        end = self.n if end is None else end
        high = np.minimum(x >> np.uint64(self.low_bits), np.uint64(1 << 62)).astype(np.int64)
        first = np.maximum(self._before(high), begin)
        last = np.minimum(self._before(high + 1), end)
        low = x & np.uint64((1 << self.low_bits) - 1)
        a, b = np.minimum(first, end), np.maximum(last, np.minimum(first, end))
        a, b = a.copy(), b.copy()
        live = np.flatnonzero(a < b)
        while len(live):  # binary search among equal high bits
            mid = (a[live] + b[live]) >> 1
            less = self._low(mid) < low[live]
            a[live] = np.where(less, mid + 1, a[live])
            b[live] = np.where(less, b[live], mid)
            live = live[a[live] < b[live]]
        return a

    def find(self, x: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> np.ndarray:
        """The place in [begin, end) that holds x, else -1.  Best with
        ascending x.  The few numbers with the high bits of x are walked over
        one by one, where there are many the successor is searched."""
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        end = np.minimum(np.broadcast_to(self.n if end is None else end, len(x)), self.n)
        high = np.minimum(x >> np.uint64(self.low_bits), np.uint64(1 << 62)).astype(np.int64)
        low = x & np.uint64((1 << self.low_bits) - 1)
        at = np.maximum(self._before(high), begin)
        live = np.flatnonzero(at < end)
        for _ in range(4):
            place = at[live]
            bit = place + high[live]  # where a number of these high bits would stand
            byte = np.minimum(bit >> 3, len(self.vector) - 1)
            same = (bit >> 3 == byte) & ((self.vector[byte] >> (bit & 7).astype(np.uint8)) & 1 == 1)
            live, place = live[same], place[same]
            if not len(live):
                return out
            value = self._low(place)
            hit = value == low[live]
            out[live[hit]] = place[hit]
            live = live[value < low[live]]
            at[live] += 1
            live = live[at[live] < end[live]]
            if not len(live):
                return out
        place = self.successor(x[live], at[live], end[live])
        inside = np.flatnonzero(place < end[live])
        same = self.get(place[inside]) == x[live[inside]]
        out[live[inside[same]]] = place[inside[same]]
        return out
