"""Words and their hashes in numpy, straight from the bytes of an Arrow string column.

A word's 64-bit hash is a polynomial over its bytes: with c the running sum of table[b] * p**i, a word from s to e has
(c[e] - c[s]) * p**-s, whatever stands before it. So a whole batch is hashed by a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_STEP = _U(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each bit of the result depends on all bits of h."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_TABLE = mix((np.arange(256, dtype=np.uint64) + _U(1)) * _U(_P))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


#: Bytes that are hashed at once: tables and sums stay of this size, unless a single word is longer.
BLOCK = 1 << 20


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) >= n:
        return _powers
    found = []
    for base in (_P, _P_INVERSE):
        run = np.full(max(n, 1 << 19), base, np.uint64)
        run[0] = 1
        found.append(np.cumprod(run))
    if n <= 2 * BLOCK:  # a longer one isn't kept
        _powers[:] = found
    return found


def forget() -> None:
    """Drops the tables of powers; the next text has them made again, in milliseconds."""
    _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def delimiters(*ranges: tuple[int, int]) -> np.ndarray:
    """256 booleans: true for bytes that belong to words."""
    is_word = np.ones(256, bool)
    for lo, hi in ranges:
        is_word[lo : hi + 1] = False
    return is_word


#: Words [^\x20\x09-\x0D]+.
SPACED = delimiters((0x20, 0x20), (0x09, 0x0D))
#: Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after A-Z are lower-cased).
ALNUM = delimiters((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: Lower-cases A-Z and leaves all other bytes.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes, one text after another, and where each begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of texts of together about `limit` bytes; a longer text comes alone. All texts are covered."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


@dataclass
class Words:
    data: np.ndarray  # bytes, folded if asked for
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # text t has words first[t] to first[t + 1]

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; none crosses an offset."""
    n = len(member)
    begins, closes = member.copy(), member.copy()
    if n:
        begins[1:] &= ~member[:-1]
        closes[:-1] &= ~member[1:]
        at = offsets[1:-1]
        at = at[(at > 0) & (at < n)]
        begins[at] = member[at]
        closes[at - 1] = member[at - 1]
    return np.flatnonzero(begins), np.flatnonzero(closes) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[s:e] for each span (none empty), by their starts; long data block by block."""
    out = np.zeros(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = len(starts) if len(data) <= BLOCK else max(lo + 1, int(np.searchsorted(starts, starts[lo] + BLOCK)))
        a, b = int(starts[lo]), int(ends[lo:hi].max())
        power, inverse = _power_tables(b - a + 1)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_TABLE[data[a:b]] * power[: b - a], out=total[1:])
        out[lo:hi] = mix((total[ends[lo:hi] - a] - total[starts[lo:hi] - a]) * inverse[starts[lo:hi] - a])
        lo = hi
    return out


def scan(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = SPACED, fold: np.ndarray | None = None) -> Words:
    if fold is not None:
        data = fold[data]
    starts, ends = runs(is_word[data], offsets)
    return Words(data, starts, ends, span_hashes(data, starts, ends), np.searchsorted(starts, offsets))


def scan_column(column, is_word: np.ndarray = SPACED, fold: np.ndarray | None = None, limit: int = 1 << 18) -> Iterator[tuple[int, int, Words]]:
    """(first text, end, their words) piece by piece."""
    data, offsets = utf8(column)
    for lo, hi in pieces(offsets, limit):
        yield lo, hi, scan(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], is_word, fold)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words, whatever text they belong to; see inside()."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= _STEP
        out += hashes[j : j + n]
    return mix(out)


def inside(first: np.ndarray, k: int) -> np.ndarray:
    """Which of grams() lie within one text."""
    n = max(0, int(first[-1]) - k + 1)
    ok = np.ones(n, bool)
    for b in range(1, k):  # a window that begins b words before a text's end and needs more
        at = first[1:-1] - b
        at = at[(at >= 0) & (at < n)]
        ok[at] = False
    return ok
