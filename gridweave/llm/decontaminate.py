"""Benchmark decontamination by a Wu-Manber multi-pattern search over words.

Texts are lower-cased (A-Z) and cut into words of letters, digits and non-ASCII characters. The patterns are the windows of
`ngram` consecutive words of the benchmark items; an item with fewer words is one shorter window. For each pattern length m
a search looks at the block of the last two words of a possible occurrence. The shift table says how far the next occurrence
can be at least, so most positions are never looked at; a shift of zero leads to the bucket of the patterns that end with
this block, and those are compared word by word, at last byte by byte.

Each task walks many texts in lockstep: one cursor for each stretch of 512 positions, all moved by the same array operation.

Results for odd input: null and empty texts have no words and no hits; an item without words is no pattern; an item with a
null id is ignored; repeated items, documents and ids are each treated as rows of their own, an item id counts once a
document. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import lean, picked, ship
from .words import ALNUM, FOLD, Words, grams, scan_column

#: Positions that one cursor walks.
STRETCH = 512
#: Bytes of benchmark text whose tables go to the executors at once, at most some 80 bytes for each word of them; a larger benchmark is searched slice after slice.
SLICE_BYTES = 2 << 20

OUTPUT = "doc_id long, key long, n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>"


class Text:
    """The words of all items, one after another, as numbers into one buffer."""

    def __init__(self, texts: list[str]):
        parts, self.count, at = [], [], 0
        for _, _, w in scan_column(pa.array(texts, pa.large_string()), ALNUM, FOLD):
            parts.append((w.data, (w.starts + at).astype(np.int32), (w.ends + at).astype(np.int32), w.hashes))
            self.count.append(np.diff(w.first))
            at += len(w.data)
        joined = lambda k, kind: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kind)
        self.data, self.starts, self.ends, self.hashes = (joined(k, kind) for k, kind in enumerate((np.uint8, np.int32, np.int32, np.uint64)))
        self.count = np.concatenate(self.count).astype(np.int64) if self.count else np.zeros(0, np.int64)

    def words(self, i: int, n: int) -> list[bytes]:
        return [self.data[self.starts[k] : self.ends[k]].tobytes() for k in range(i, i + n)]


class WuManber:
    """Patterns of one length: windows of a Text, by their first words."""

    def __init__(self, length: int, text: Text, at: np.ndarray, owner: np.ndarray):
        """at: where the windows begin; owner: the item that each belongs to. Equal windows are one pattern with several owners."""
        self.length, self.block, self.text = length, min(2, length), text
        whole = grams(text.hashes, length)[at]
        order = np.lexsort((owner, whole))
        at, owner, whole = at[order], owner[order], whole[order]
        new = np.ones(len(at), bool)
        new[1:] = whole[1:] != whole[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        for k in np.flatnonzero(~new).tolist():  # windows that items share: by their bytes
            if text.words(at[k], length) != text.words(at[first[k]], length):
                new[k] = True
        begin = np.flatnonzero(new)
        blocks = grams(text.hashes, self.block)
        suffix = blocks[at[begin] + length - self.block]
        order = np.argsort(suffix, kind="stable")
        self.at, self.suffix = at[begin[order]].astype(np.int32), suffix[order]
        ends = np.append(begin[1:], len(at))
        size = (ends - begin)[order]
        self.owners = owner[np.repeat(begin[order] - (np.cumsum(size) - size), size) + np.arange(size.sum())].astype(np.int32)
        self.owned = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
        self.bits = max(12, int(16 * min(len(blocks), len(begin) * (length - self.block + 1))).bit_length())
        most = length - self.block + 1
        self.shift = np.full(1 << self.bits, most, np.uint8 if most < 256 else np.int32)
        for j in range(most):  # the later block wins: it allows the smaller shift
            self.shift[self._slot(blocks[self.at + j])] = most - 1 - j

    def _slot(self, block: np.ndarray) -> np.ndarray:
        return (block >> np.uint64(64 - self.bits)).astype(np.int64)

    def candidates(self, w: Words) -> np.ndarray:
        """First words of the windows whose last block ends some pattern."""
        m, counts = self.length, np.diff(w.first)
        long = counts >= m
        begin, stop = w.first[:-1][long] + m - 1, w.first[1:][long]  # last words of windows
        if not len(begin):
            return np.zeros(0, np.int64)
        blocks = grams(w.hashes, self.block)  # block i ends with word i + block - 1
        shift = self.shift[self._slot(blocks)]
        n = -(-(stop - begin) // STRETCH)
        owner = np.repeat(np.arange(len(n)), n)
        at = begin[owner] + STRETCH * (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n))
        end = np.minimum(at + STRETCH, stop[owner])
        found = []
        while len(at):
            step = shift[at - self.block + 1]
            zero = step == 0
            if zero.any():
                found.append(at[zero] - m + 1)
            at = at + np.maximum(step, 1)
            alive = at < end
            at, end = at[alive], end[alive]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def search(self, w: Words) -> Iterator[tuple[int, int]]:
        """(first word, pattern) of each occurrence."""
        at = self.candidates(w)
        if not len(at):
            return
        last = grams(w.hashes, self.block)[at + self.length - self.block]
        lo, hi = np.searchsorted(self.suffix, last), np.searchsorted(self.suffix, last, "right")
        n = hi - lo
        where = np.repeat(at, n)
        which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        same = np.ones(len(where), bool)
        for j in range(self.length):
            same[same] = w.hashes[where[same] + j] == self.text.hashes[self.at[which[same]] + j]
        for i, p in zip(where[same].tolist(), which[same].tolist(), strict=True):
            if [w.word(k) for k in range(i, i + self.length)] == self.text.words(self.at[p], self.length):
                yield i, p


class Searcher:
    """The windows of a set of items, grouped by length."""

    def __init__(self, items: list[tuple[str, str | None]], ngram: int):
        self.names = sorted({name for name, _ in items})
        index = {name: k for k, name in enumerate(self.names)}
        text = Text([t or "" for _, t in items])
        owner = np.array([index[name] for name, _ in items], np.int64)
        first = np.cumsum(text.count) - text.count
        length = np.minimum(ngram, text.count)
        self.groups = []
        for m in np.unique(length[length > 0]).tolist():
            own = np.flatnonzero(length == m)
            n = text.count[own] - m + 1
            at = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            self.groups.append(WuManber(m, text, at, np.repeat(owner[own], n)))

    def search(self, w: Words) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Which words lie in an occurrence; the items found, by text."""
        cover, items = np.zeros(len(w.hashes) + 1, np.int64), {}
        for group in self.groups:
            for i, p in group.search(w):
                cover[i] += 1
                cover[i + group.length] -= 1
                text = int(np.searchsorted(w.first, i, "right")) - 1
                items.setdefault(text, set()).update(self.names[k] for k in group.owners[group.owned[p] : group.owned[p + 1]].tolist())
        return np.cumsum(cover[:-1]) > 0, items


def hits(column, searcher: Searcher) -> Iterator[tuple[int, int, list[str], list[int]]]:
    """For each text: words, words hit, items found, and the hit stretches as start, end, start, end, ... in words."""
    for lo, hi, w in scan_column(column, ALNUM, FOLD):
        hit, items = searcher.search(w)
        count = np.diff(w.first).tolist()
        for t in range(hi - lo):
            if t not in items:
                yield count[t], 0, [], []
                continue
            own = hit[w.first[t] : w.first[t + 1]]
            edge = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8)))
            yield count[t], int(own.sum()), sorted(items[t]), edge.tolist()


def _slices(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str, str | None]]]:
    """The benchmark in parts of at most SLICE_BYTES (or one item), each fetched when it is used."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("id is not null")
    own: list[tuple[str, str | None]] = []
    size = 0
    for row in items.toLocalIterator():
        if own and size + len(row.text or "") > SLICE_BYTES:
            yield own
            own, size = [], 0
        own.append((row.id, row.text))
        size += len(row.text or "")
    yield own


def decontaminate(docs: DataFrame, benchmark: DataFrame, ngram: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each document: n_words, n_hit, items (sorted as strings) and spans (start, end, ... of hit words).

    Only the benchmark goes to the executors, in slices of a checked size; the documents never move for one slice. Over more
    slices each is a pass of its own, and the passes' small rows meet by id and text hash.
    """
    source = picked(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))
    passes = [source.mapInArrow(lean(_search_with(docs.sparkSession.sparkContext.broadcast(Searcher(items, ngram)))), OUTPUT) for items in _slices(benchmark, item_col, item_text_col)]
    if len(passes) == 1:
        return passes[0].drop("key")
    met = passes[0]
    for other in passes[1:]:
        met = met.union(other)
    hit = "array_distinct(flatten(transform(flatten(collect_list(spans)), s -> sequence(s.start, s.end - 1))))"
    met = met.groupBy("doc_id", "key").agg(F.first("n_words").alias("n_words"), F.expr(f"cast(size({hit}) as long)").alias("n_hit"), F.expr("array_sort(array_distinct(flatten(collect_list(items))))").alias("items"), F.expr("array_sort(array_distinct(flatten(collect_list(spans))))").alias("spans"), F.count("*").alias("copies"))
    return met.withColumn("copy", F.explode(F.expr(f"sequence(1, cast(copies / {len(passes)} as int))"))).drop("key", "copies", "copy")


def contaminated(column, searcher: Searcher) -> np.ndarray:
    """Which texts have a hit."""
    return np.array([h > 0 for _, h, _, _ in hits(column, searcher)], bool)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, ngram: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents without any hit, with all their columns; nothing is shuffled."""
    ship(docs.sparkSession)
    for items in _slices(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(Searcher(items, ngram))

        def keep(batches, shared=shared):
            for b in batches:
                yield b.filter(pa.array(~contaminated(b.column(text_col), shared.value), pa.bool_()))

        docs = docs.mapInArrow(lean(keep), docs.schema)
    return docs


def _search_with(shared):
    def search(batches):
        for b in batches:
            n, h, items, spans = ([*x] for x in zip(*hits(b.column("text"), shared.value), strict=True)) if b.num_rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(n, pa.int64()), pa.array(h, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array([[{"start": s, "end": e} for s, e in zip(x[::2], x[1::2], strict=True)] for x in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["doc_id", "key", "n_words", "n_hit", "items", "spans"])

    return search
