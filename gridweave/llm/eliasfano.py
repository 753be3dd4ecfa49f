"""Elias-Fano coding of monotone sequences in numpy, read in place from a buffer (or a memory-mapped file).

n values below a universe u: the low l = log2(u / n) bits of each, rounded up to bytes, stand in planes; the high parts stand
in unary, a one for each value and a zero for each step of the high part. Reading needs no copy of the buffer, only a running count for each 512 bits
of the unary part: the place of a one or zero is found by its block, then its byte. successor() finds, for many values at once, the first element that is not less, by halving the elements
that share a value's high part. What is asked in ascending order and stands close together (QUERIES at once, within WINDOW elements) is read in one go from that part of the buffer.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQQ")
#: Bytes of unary part for each running count, and places looked for at once.
BLOCK, QUERIES = 64, 1 << 15
#: Elements read in one go for so many places looked for at once.
WINDOW = 1 << 20
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)
_ONES = _BITS.sum(1).astype(np.uint8)
#: Where in a byte its r-th one stands.
_PLACE = np.argsort(1 - _BITS, axis=1, kind="stable").astype(np.uint8)


def encode(values: np.ndarray) -> bytes:
    """values: uint64, ascending (equal neighbours are allowed). They are coded relative to the first."""
    n = len(values)
    if not n:
        return _HEAD.pack(0, 0, 0)
    base = values[0]
    x = values - base
    top = int(x[-1])
    width = max(0, -(-((top // n).bit_length()) // 8))  # bytes of a low part
    low = x[:, None].view(np.uint8)[:, :width].T.copy()  # little-endian: the first bytes are the low ones
    high = (x >> np.uint64(8 * width)).astype(np.int64) if width < 8 else np.zeros(n, np.int64)
    bits = np.zeros(n + int(high[-1]) + 1, np.uint8)
    bits[high + np.arange(n)] = 1
    return _HEAD.pack(n, int(base), width) + low.tobytes() + np.packbits(bits).tobytes()


class EliasFano:
    """Views into a buffer that encode() has made."""

    def __init__(self, buffer):
        self.n, self.base, self.width = _HEAD.unpack_from(buffer, 0)
        raw = np.frombuffer(buffer, np.uint8)
        end = _HEAD.size + self.n * self.width
        self.low = raw[_HEAD.size : end].reshape(self.width, self.n)
        self.unary = raw[end:]
        whole = len(self.unary) // BLOCK
        self.blocks, tail = self.unary[: whole * BLOCK].reshape(whole, BLOCK), np.zeros((1, BLOCK), np.uint8)
        tail[0, : len(self.unary) - whole * BLOCK] = self.unary[whole * BLOCK :]
        self.tail = tail
        counts = [_ONES[self.blocks[k : k + 4096]].sum(1, dtype=np.int64) for k in range(0, whole, 4096)]
        self.ones = np.concatenate(([0], np.cumsum(np.concatenate([*counts, _ONES[tail].sum(1, dtype=np.int64)]))))
        self.zeros = np.arange(len(self.ones)) * 8 * BLOCK - self.ones

    def __len__(self) -> int:
        return self.n

    def place(self, r: np.ndarray, one: bool = True) -> np.ndarray:
        """Where the r-th one (or zero) of the unary part stands."""
        out, before = np.empty(len(r), np.int64), self.ones if one else self.zeros
        for lo in range(0, len(r), QUERIES):
            want = r[lo : lo + QUERIES]
            block = np.searchsorted(before, want, "right") - 1
            own = self.blocks[np.minimum(block, max(0, len(self.blocks) - 1))] if len(self.blocks) else np.zeros((len(want), BLOCK), np.uint8)
            own[block == len(self.blocks)] = self.tail[0]
            own = own if one else ~own
            count = _ONES[own].cumsum(1, dtype=np.int32)
            left = want - before[block]
            byte = (count <= left[:, None]).sum(1)
            rows = np.arange(len(want))
            there = own[rows, byte]
            out[lo : lo + QUERIES] = (block * BLOCK + byte) * 8 + _PLACE[there, left - (count[rows, byte] - _ONES[there])]
        return out

    def high(self) -> np.ndarray:
        """The high parts of all values; for decode(), which makes as many numbers anyway."""
        return np.flatnonzero(np.unpackbits(self.unary))[: self.n] - np.arange(self.n)

    def get(self, i: np.ndarray) -> np.ndarray:
        out = np.empty(len(i), np.uint64)
        for lo in range(0, len(i), QUERIES):
            own = i[lo : lo + QUERIES]
            if _close(own, int(own[0]), int(own[-1])):
                out[lo : lo + QUERIES] = self.window(int(own[0]), int(own[-1]) + 1)[own - own[0]]
            else:
                out[lo : lo + QUERIES] = self._joined(own, self.place(own) - own if self.width < 8 else None)
        return out

    def window(self, begin: int, end: int) -> np.ndarray:
        """The elements from begin to end, read from their part of the buffer."""
        i = np.arange(begin, end)
        if begin >= end or self.width == 8:
            return self._joined(i, None if self.width == 8 else i)
        first, last = self.place(np.array([begin, end - 1])).tolist()
        bits = np.unpackbits(self.unary[first // 8 : last // 8 + 1])
        ones = np.flatnonzero(bits[first % 8 :])[: end - begin] + first
        return self._joined(i, ones - i)

    def _joined(self, i: np.ndarray, high: np.ndarray | None) -> np.ndarray:
        x = high.astype(np.uint64) << np.uint64(8 * self.width) if high is not None else np.zeros(len(i), np.uint64)
        for k in range(self.width):
            x |= self.low[k][i].astype(np.uint64) << np.uint64(8 * k)
        return x + np.uint64(self.base)

    def decode(self) -> np.ndarray:
        return self._joined(np.arange(self.n), self.high() if self.width < 8 else None) if self.n else np.zeros(0, np.uint64)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first element >= x (n if there is none), for each x."""
        out = np.zeros(len(x), np.int64)
        for lo in range(0, len(x) if self.n else 0, QUERIES):
            own = x[lo : lo + QUERIES]
            begin, end = self._halved(own[[0, -1]]).tolist()
            if _close(own, begin, end):
                out[lo : lo + QUERIES] = begin + np.searchsorted(self.window(begin, end), own)
            else:
                out[lo : lo + QUERIES] = self._halved(own)
        return out

    def _halved(self, x: np.ndarray) -> np.ndarray:
        base = np.uint64(self.base)
        under = x < base
        rel = np.where(under, np.uint64(0), x - base)
        part = (rel >> np.uint64(8 * self.width)).astype(np.int64) if self.width < 8 else np.zeros(len(x), np.int64)
        steps = 8 * len(self.unary) - self.n  # zeros, those that fill the last byte included
        last = int(self.place(np.array([self.n - 1]))[0]) - (self.n - 1)  # the largest high part
        inner = part <= last
        at, end = np.full(len(x), self.n, np.int64), np.full(len(x), self.n, np.int64)
        some, own = np.flatnonzero(inner), part[inner]
        at[some] = np.where(own > 0, self.place(np.maximum(own - 1, 0), False) - np.maximum(own - 1, 0), 0)
        end[some] = np.where(own < min(steps, last + 1), self.place(own, False) - own, self.n)
        at = np.where(under, 0, at)
        open_ = np.flatnonzero(~under & (at < end))
        while len(open_):  # halving what is left of the elements that share the high part
            middle = (at[open_] + end[open_]) // 2
            less = self.get(middle) < x[open_]
            at[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]
            open_ = open_[at[open_] < end[open_]]
        return at


def _close(asked: np.ndarray, begin: int, end: int) -> bool:
    """Is what is asked in ascending order, and is reading all elements between less work than looking for each?"""
    return 0 <= end - begin <= min(WINDOW, 64 * len(asked)) and bool((asked[1:] >= asked[:-1]).all())
