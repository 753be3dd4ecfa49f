"""Packing by lexical retrieval: BM25 neighbours fill each seed document's window.

Every text is tokenised once; from there on only its ids move, two bytes each for vocabularies of up to 65,536. Terms are token ids: document
frequencies and the mean length are those of the whole corpus, exact, in a table as large as the vocabulary. Documents are dealt into shards of about
SHARD_TOKENS by two lexical keys, consistent samples of a document's terms weighted by idf: two documents agree in a key with a chance of their weighted
Jaccard similarity, wherever they stand in the corpus. Small first keys share a shard, a large one is divided by the second key, and what is too
large even so (copies of one text, say) is dealt by row. A shard builds a BM25 inverted index over its documents (terms in more than half of the corpus have no weight). The first document
without a place is the seed of a window of 1024 tokens; the index returns its neighbours that have no place yet, the best first, and they fill the
window one after another. Who doesn't fit is cut: its rest is the seed of the next window. Without a neighbour the next document in order follows.
So only a shard's very last window isn't full; it is laid out as sequences of falling powers of two, and nothing needs padding. Each
document ends with id 0.

A shard is one task's work, of bounded size unless a single text is larger; shards don't depend on each other, and a lost one is made
again from its documents alone. The driver holds a number for each vocabulary entry, nothing for each document or shard.

Odd input: null and empty texts are the single id 0; a null id comes last in its shard and is returned as null; repeated rows are packed each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import cut, lean, partitions, picked, trim
from .pretokens import Encoder
from .words import mix

WINDOW = 1024
SHARD_TOKENS = 1 << 20
K1, B = 1.5, 0.75
#: Characters tokenised at once, and tokens looked at at once.
PIECE_CHARS, PIECE_TOKENS = 1 << 20, 1 << 20
#: Rows of three numbers up to which the table of divided shards is broadcast; a larger one is joined by a shuffle.
MOST_BROADCAST = 100_000
#: A term in more than one of so many of an index's documents is a row of its matrix; an index shrinks when fewer than this share of its documents have no place yet.
DENSE, SHRINK = 8, 0.75
#: First keys for documents that have no term with a weight.
SPARE = 64

OUTPUT = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_TOKENS = "doc_id long, row long, n long, ids binary"


@dataclass
class Statistics:
    """Of the whole corpus: documents, their mean length, and each term's document frequency (terms beyond the table: none)."""

    n: int
    mean: float
    df: np.ndarray

    def idf(self) -> np.ndarray:
        return idf_of(self.n, self.df)


def idf_of(n: int, df: np.ndarray) -> np.ndarray:
    return np.maximum(0, np.log((n - df + 0.5) / (df + 0.5)))


def _key(major: np.ndarray, minor: np.ndarray, minors: int) -> np.ndarray:
    """major * minors + minor, in as few bits as it needs: they are sorted."""
    kind = np.uint32 if (int(major.max(initial=0)) + 1) * minors <= 1 << 32 else np.uint64
    key = major.astype(kind)
    key *= kind(minors)
    key += minor.astype(kind)
    return key


def _news(key: np.ndarray) -> np.ndarray:
    """Where a new value begins among sorted ones."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return new


class Index:
    """An inverted index of a shard, with BM25 weights, by the corpus's statistics (or else the shard's own).

    Terms in many of its documents are rows of a matrix, the others have postings. Weights are multiples of 2**-24, so that sums are exact in any order and copies of a text have equal scores.
    """

    def __init__(self, terms: np.ndarray, at: np.ndarray, corpus: Statistics | None = None):
        self.n = len(at) - 1
        size = np.diff(at)
        key = _key(terms, np.repeat(np.arange(self.n), size), self.n)
        key.sort()
        first = np.flatnonzero(_news(key))
        tf = np.diff(np.append(first, len(key)))
        term, doc = (x.astype(np.int64) for x in np.divmod(key[first], key.dtype.type(max(1, self.n))))
        df = np.bincount(term)
        idf = idf_of(self.n, df) if corpus is None else corpus.idf()
        mean = corpus.mean if corpus else size.mean() if self.n else 1.0
        keep = (idf[term] > 0) & (df[term] > 1) if len(df) else np.zeros(0, bool)
        term, doc, tf = term[keep], doc[keep], tf[keep]
        weight = (idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[doc] / max(1.0, mean)))).astype(np.float32)
        weight = np.rint(weight * np.float64(1 << 24)) / (1 << 24)
        self.own = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=self.n)))).astype(np.int64)
        self.terms = term[np.argsort(doc.astype(np.uint16) if self.n <= 1 << 16 else doc, kind="stable")]  # by document
        self._build(np.arange(self.n), term, doc, weight, len(df))

    def _build(self, docs: np.ndarray, term: np.ndarray, doc: np.ndarray, weight: np.ndarray, terms: int) -> None:
        """Of postings sorted by term; doc: places in docs."""
        self.docs, self.term, self.doc, self.weight, self.size = docs, term, doc, weight, terms
        self.count = np.bincount(term, minlength=terms)
        self.begin = np.cumsum(self.count) - self.count
        dense = np.flatnonzero(self.count * DENSE > max(DENSE, len(docs)))
        self.row = np.full(terms, -1)
        self.row[dense] = np.arange(len(dense))
        self.rows = np.zeros((len(dense), len(docs)))
        own = self.row[term]
        at = np.flatnonzero(own >= 0)
        self.rows[own[at], doc[at]] = weight[at]

    def among(self, free: np.ndarray) -> Index:
        """The index of those of its documents that are free; any document's neighbours can still be asked for."""
        keep = free[self.docs]
        at = np.flatnonzero(keep[self.doc])
        out = object.__new__(Index)
        out.n, out.own, out.terms = self.n, self.own, self.terms
        out._build(self.docs[keep], self.term[at], (np.cumsum(keep) - 1)[self.doc[at]], self.weight[at], self.size)
        return out

    def scores(self, seed: int) -> np.ndarray:
        terms = self.terms[self.own[seed] : self.own[seed + 1]]
        row = self.row[terms]
        rare = terms[row < 0]
        head, count = self.begin[rare], self.count[rare]
        end = np.cumsum(count)
        at = np.repeat(head - (end - count), count)
        at += np.arange(len(at))
        out = np.zeros(self.n)
        out[self.docs] = np.bincount(self.doc[at], self.weight[at], len(self.docs)) + self.rows[row[row >= 0]].sum(0)
        return out


def laid_out(sizes: np.ndarray, index: Index, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece."""
    free, left = np.ones(len(sizes), bool), len(sizes)
    out: list[tuple[int, int, int, int, int]] = []
    sequence, used, cursor = 0, 0, 0
    seed, scores = -1, None
    for _ in range(len(sizes)):
        doc = -1
        if used and seed >= 0:
            if scores is None:
                if left < SHRINK * len(index.docs):
                    index = index.among(free)
                scores = np.where(free, index.scores(seed), 0)
            best = int(scores.argmax())  # the first of equals
            if scores[best] > 0:
                doc, scores[best] = best, 0
        if doc < 0:
            while not free[cursor]:
                cursor += 1
            doc = cursor
        free[doc] = False
        left -= 1
        if scores is not None:
            scores[doc] = 0
        start = 0
        while start < sizes[doc]:
            if not used:
                seed, scores = doc, None
            n = int(min(window - used, sizes[doc] - start))
            out.append((doc, start, n, sequence, used))
            start += n
            used += n
            if used == window:
                sequence, used = sequence + 1, 0
    if used:  # the last window: falling powers of two
        last = [p for p in out if p[3] == sequence]
        out = out[: len(out) - len(last)]
        room, filled = 1 << (used.bit_length() - 1), 0
        left = used
        for doc, start, n, _, _ in last:
            while n:
                m = min(n, room - filled)
                out.append((doc, start, m, sequence, filled))
                start, n, filled, left = start + m, n - m, filled + m, left - m
                if filled == room and left:
                    sequence, room, filled = sequence + 1, 1 << (left.bit_length() - 1), 0
    return out


def kind_of(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _runs(sizes: list[int], limit: int):
    """Ranges of neighbours of together at most limit, or of one."""
    lo = 0
    while lo < len(sizes):
        hi, n = lo + 1, sizes[lo]
        while hi < len(sizes) and n + sizes[hi] <= limit:
            n += sizes[hi]
            hi += 1
        yield lo, hi
        lo = hi


def _tokenised(path: str, kind: str):
    def work(batches):
        encoder = Encoder.of(path)
        for b in batches:
            column = b.column("text").to_pylist()
            for lo, hi in _runs([len(t or "") for t in column], PIECE_CHARS):
                texts = [t or "" for t in column[lo:hi]]
                column[lo:hi] = [None] * (hi - lo)
                ids, at = encoder.encode(texts)
                flat = np.insert(ids, at[1:], 0).astype(kind)
                ends = at[1:] + np.arange(1, len(at))
                begin = np.concatenate(([0], ends[:-1]))
                own = [flat[s:e].tobytes() for s, e in zip(begin.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), b.column("row").slice(lo, hi - lo), pa.array(ends - begin), pa.array(own, pa.binary())], ["doc_id", "row", "n", "ids"])
        encoder.forget()

    return work


def _parts(batches, kind: str):
    """(batch of rows, their ids, where each row's begin) of about PIECE_TOKENS ids; a longer text comes alone."""
    for b in batches:
        n = b.column("n").to_pylist()
        for lo, hi in _runs(n, PIECE_TOKENS):
            part = b.slice(lo, hi - lo)
            yield part, np.frombuffer(b"".join(part.column("ids").to_pylist()), kind), np.concatenate(([0], np.cumsum(n[lo:hi]))).astype(np.int64)


def _frequencies(kind: str, vocabulary: int):
    """(term, n): in how many of the task's documents each term is."""

    def work(batches):
        df = np.zeros(vocabulary, np.int64)
        for _, ids, at in _parts(batches, kind):
            key = _key(ids, np.repeat(np.arange(len(at) - 1), np.diff(at)), len(at))
            key.sort()
            df += np.bincount((key[_news(key)] // key.dtype.type(len(at))).astype(np.int64), minlength=vocabulary)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "n"])

    return work


def statistics(tokens: DataFrame, kind: str, vocabulary: int) -> Statistics:
    total = tokens.agg(F.count("*").alias("n"), F.sum("n").alias("length")).first()
    t = tokens.mapInArrow(lean(_frequencies(kind, vocabulary)), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # at most a row for each vocabulary entry
    df = np.zeros(vocabulary, np.int64)
    df[t.column("term").to_numpy()] = t.column("n").to_numpy()
    df[0] = total.n  # the end of every document
    return Statistics(total.n, (total.length or 0) / max(1, total.n), df)


def drawn(corpus: Statistics) -> list[np.ndarray]:
    """For each key, every term's place: each draws an exponential of rate idf, and a document's key is its term with the first place. Terms without a weight have none (the last place)."""
    idf, out = np.where(corpus.df > 1, corpus.idf(), 0), []  # a term of one document brings it no company
    for k in (1, 2):
        h = mix(np.arange(len(idf), dtype=np.uint64) + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64)))
        with np.errstate(divide="ignore"):
            draw = np.where(idf > 0, -np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / idf, np.inf)
        place = np.empty(len(idf), np.int32)
        place[np.argsort(draw, kind="stable")] = np.arange(len(idf))
        out.append(np.where(np.isfinite(draw), place, len(idf)).astype(np.int32))
    return out


def _keys(places: list[np.ndarray], ids: np.ndarray, at: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
    spare = (mix(row.view(np.uint64)) % np.uint64(SPARE)).astype(np.int64)
    found = [np.minimum.reduceat(p[ids], at[:-1]).astype(np.int64) for p in places]  # no document is without ids
    return [np.where(f < len(places[0]), f, len(places[0]) + spare) for f in found]


def _keyed(kind: str, shared):
    def work(batches):
        for b, ids, at in _parts(batches, kind):
            first, second = _keys(shared.value, ids, at, b.column("row").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second), b.column("n")], ["first", "second", "n"])

    return work


def starts(sizes: dict[int, int], keys: int, limit: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each first key its first shard and the number of its shards; how many shards there may be. A large key has three times its shards' numbers, for those that must be divided again."""
    start, parts, at, used = np.zeros(keys, np.int64), np.ones(keys, np.int64), 0, 0
    for k in sorted(sizes):
        if used and used + sizes[k] > limit:
            at, used = at + 1, 0
        start[k] = at
        if sizes[k] > limit:
            parts[k] = -(-sizes[k] // limit)
            at, used = at + 3 * int(parts[k]) + 1, 0
        else:
            used += sizes[k]
    return start, parts, at + 1


def _part(second, parts):
    return (mix(second.astype(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)


def _cells(shared):
    """(cell, first, n): each row's shard as far as its keys tell."""

    def work(batches):
        start, parts = shared.value
        for b in batches:
            first = b.column("first").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(start[first] + _part(b.column("second").to_numpy(), parts[first])), b.column("first"), b.column("n")], ["cell", "first", "n"])

    return work


def _dealt(kind: str, shared, dealing):
    def work(batches):
        start, parts = dealing.value
        for b, ids, at in _parts(batches, kind):
            first, second = _keys(shared.value, ids, at, b.column("row").to_numpy())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "row", "ids")), pa.array(start[first] + _part(second, parts[first]))], ["doc_id", "row", "ids", "cell"])

    return work


def _packed(kind: str, window: int, shared):
    def packed(key, table):
        doc_id, raw = table.column("doc_id").to_pylist(), table.column("ids").to_pylist()
        order = sorted(range(len(raw)), key=lambda i: (doc_id[i] is None, doc_id[i] or 0, raw[i]))
        flat = np.frombuffer(b"".join([raw[i] for i in order]), kind)
        sizes = np.array([len(raw[i]) // flat.itemsize for i in order], np.int64)
        del raw, table
        at = np.concatenate(([0], np.cumsum(sizes)))
        pieces = np.array(laid_out(sizes, Index(flat, at, shared.value), window), np.int64)
        doc, start, n, sequence, offset = pieces.T
        begin = (at[doc] + start).tolist()
        wide = flat.astype("<u4")
        out = [wide[s : s + k].tobytes() for s, k in zip(begin, n.tolist(), strict=True)]
        del wide, flat
        trim()
        own = pa.array([doc_id[i] for i in order], pa.int64()).take(pa.array(doc))
        return pa.table([own, pa.array(start), pa.array(n), pa.array(out, pa.binary()), pa.array(sizes[doc]), pa.array((key[0].as_py() << 22) + sequence), pa.array(offset)], [x.split()[0] for x in OUTPUT.split(", ")])

    return packed


def dealt(tokens: DataFrame, corpus: Statistics, kind: str, shard_tokens: int) -> tuple[DataFrame, int]:
    """The documents (doc_id, ids) with their shard, and about how many shards there are."""
    send = tokens.sparkSession.sparkContext.broadcast  # what goes out has a few numbers for each vocabulary entry
    places = send(drawn(corpus))
    keys = cut(tokens.mapInArrow(lean(_keyed(kind, places)), "first long, second long, n long"))
    sizes = {r["first"]: r.n for r in keys.groupBy("first").agg(F.sum("n").alias("n")).collect()}  # at most a row for each vocabulary entry
    start, parts, shards = starts(sizes, len(corpus.df) + SPARE, shard_tokens)
    dealing = send((start, parts))
    rows = tokens.mapInArrow(lean(_dealt(kind, places, dealing)), "doc_id long, row long, ids binary, cell long")
    cells = keys.mapInArrow(_cells(dealing), "cell long, first long, n long").groupBy("first", "cell").agg(F.sum("n").alias("n"))
    over = cells.where(F.col("n") > 2 * shard_tokens).withColumn("subs", F.ceil(F.col("n") / shard_tokens).cast("long"))
    before = Window.partitionBy("first").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # a row for each divided shard
    over = over.withColumn("before", F.coalesce(F.sum("subs").over(before), F.lit(0)))
    large = np.flatnonzero(parts > 1).tolist()
    if not large:
        return rows.select("doc_id", "ids", F.col("cell").alias("shard")), shards
    numbers = tokens.sparkSession.createDataFrame([(k, int(start[k] + parts[k])) for k in large], "first long, spare long")
    over = cut(over.join(numbers, "first").select("cell", "subs", (F.col("spare") + F.col("before")).alias("base")))
    shard = F.when(F.col("subs").isNull(), F.col("cell")).otherwise(F.col("base") + F.pmod(F.xxhash64("row"), F.col("subs")))
    if over.count() <= MOST_BROADCAST:
        over = F.broadcast(over)
    return rows.join(over, "cell", "left").select("doc_id", "ids", shard.alias("shard")), shards


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids (unsigned 32-bit, little-endian), doc_tokens, sequence_id, offset."""
    docs = picked(docs, id_col, text_col)
    vocabulary = 1 + max(Encoder.ids_of(tokenizer_path))
    kind = kind_of(vocabulary)
    tokens = cut(docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(lean(_tokenised(tokenizer_path, kind)), _TOKENS))
    corpus = statistics(tokens, kind, vocabulary)
    rows, shards = dealt(tokens, corpus, kind, shard_tokens)
    tasks = min(shards, max(partitions(docs.sparkSession), shards // 8))
    shared = docs.sparkSession.sparkContext.broadcast(corpus)
    return rows.repartition(tasks, "shard").groupBy("shard").applyInArrow(_packed(kind, window, shared), OUTPUT)


def crc32_of(ids: bytes) -> int:
    return zlib.crc32(ids)
