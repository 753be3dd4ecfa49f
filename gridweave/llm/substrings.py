"""Removal of repeated substrings by de Bruijn compaction.

A window of `k` words (13) is an edge of the de Bruijn graph from its first k-1 to its last k-1 words; an edge is coloured by
the smallest id of the documents in which it starts. Steps, by bucket or shard (see buckets.py):

1. each bucket sends its distinct edges (64-bit hashes) with the first document that has them to the shards of the hash space;
2. a shard joins the messages and answers, for each edge that starts in an earlier document, which document and which bucket has it;
3. a bucket walks its documents: consecutive edges of one colour are a path through which no other first document branches off; it compacts to one row (first edge, number of
   edges, source document, a 128-bit digest of all its words' bytes). Rows that many buckets have are one row from here on, by a Spark aggregation;
4. joined with its source's bucket, a path is laid on each place of the source at which its first edge stands, and holds if the digest of the words there is the same;
5. joined back, paths that hold are removed. One that doesn't (its edges stand apart in the source, or a hash lied) is cut into its single
   edges, and those are verified in the same way; only what is verified is removed.

Colours take the place of node degrees: a path ends where the first document changes, so it can be verified at one source. Degrees would need messages
by node and next word, half as large again.

A hot passage or group of copies costs each bucket one message entry and one row, however many documents hold it; a bucket that very many paths have as their source
is copied for each REQUESTS of them.

Odd input: null or empty texts have no words and nothing removed; null ids count as larger than any other; of rows with equal
ids none is smaller, so they don't remove each other's windows; a text of fewer than k words stays whole; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import eliasfano
from .base import cut, freed, picked
from .buckets import Plan, bucketed, expand, id_column, squeeze, unpack_texts
from .words import grams, inside, pieces, scan

OUTPUT = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start: long, end: long, source: long>>"
#: Paths that one copy of a source's bucket verifies.
REQUESTS = 200_000

_ASKED = "bucket long, shard int, blob binary"
_PATHS = "bucket long, path binary, home long, source long, edge long, n int"


class Bucket:
    """The texts of a bucket, their words and edges."""

    def __init__(self, blobs: list[bytes], k: int):
        self.k = k
        self.ids, self.data, self.offsets = unpack_texts(blobs)
        parts = [(lo, scan(self.data[self.offsets[lo] : self.offsets[hi]], self.offsets[lo : hi + 1] - self.offsets[lo])) for lo, hi in pieces(self.offsets)]
        joined = lambda xs, kind: np.concatenate(xs) if parts else np.zeros(0, kind)
        words = joined([w.hashes for _, w in parts], np.uint64)
        self.starts = joined([w.starts + self.offsets[lo] for lo, w in parts], np.int64)
        self.ends = joined([w.ends + self.offsets[lo] for lo, w in parts], np.int64)
        self.first = np.concatenate(([0], np.cumsum(joined([np.diff(w.first) for _, w in parts], np.int64)))).astype(np.int64)
        ok = inside(self.first, k)
        self.at = np.flatnonzero(ok)  # first words of the edges
        self.edges = grams(words, k)[ok]
        self.doc = np.searchsorted(self.first, self.at, "right") - 1
        self.raw = self.data.tobytes()

    def distinct(self, inverse: bool = False):
        """Distinct edges ascending, the first document (as a row) of each, and for each edge its place."""
        found = np.unique(self.edges, return_index=True, return_inverse=inverse)
        return found[0], self.doc[found[1]], found[2] if inverse else None

    def digest(self, word: int, n: int) -> bytes:
        """Of the words of n edges from a word on: their bytes, joined by spaces."""
        return hashlib.blake2b(b" ".join(self.raw[self.starts[word] : self.ends[word + n + self.k - 2]].split()), digest_size=16).digest()


def _rows(rows) -> pa.Table:
    return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["bucket", "shard", "blob"])


def _ask(plan: Plan, k: int):
    def ask(batches):
        for batch in batches:
            for number, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                bucket = Bucket([blob], k)
                edges, doc, _ = bucket.distinct()
                ids = bucket.ids[doc] if len(doc) else np.zeros(0, np.int64)
                rows = []
                for s, lo, hi in plan.shard_ranges(edges):
                    low = int(ids[lo:hi].min())
                    off = (ids[lo:hi].astype(np.uint64) - np.uint64(low % (1 << 64))).astype(np.uint64)
                    kind = np.min_scalar_type(int(off.max()))
                    code = eliasfano.encode(edges[lo:hi])
                    rows.append((number, s, len(code).to_bytes(4, "little") + low.to_bytes(8, "little", signed=True) + bytes([kind.itemsize]) + code + off.astype(kind).tobytes()))
                yield from _rows(rows).to_batches()

    return ask


def _answer(table: pa.Table) -> pa.Table:
    """For each message: a bit for each edge (does an earlier document have it?), and those documents with their buckets."""
    buckets = np.array(table.column("bucket").to_pylist(), np.int64)
    edges, ids, sizes = [], [], []
    for b in table.column("blob").to_pylist():
        n = int.from_bytes(b[:4], "little")
        edges.append(eliasfano.EliasFano(b[13 : 13 + n]).decode())
        ids.append((np.frombuffer(b, f"<u{b[12]}", offset=13 + n).astype(np.uint64) + np.uint64(int.from_bytes(b[4:12], "little"))).view(np.int64))
        sizes.append(len(edges[-1]))
    edge, doc = np.concatenate(edges), np.concatenate(ids)
    del edges, ids
    order = np.lexsort((doc, edge))
    edge = edge[order]
    starts = np.flatnonzero(np.concatenate(([True], edge[1:] != edge[:-1])))
    size = np.diff(np.append(starts, len(edge)))
    message = np.repeat(np.arange(len(sizes)), sizes)
    least, home = np.empty(len(doc), np.int64), np.empty(len(doc), np.int64)
    least[order] = np.repeat(doc[order[starts]], size)
    home[order] = np.repeat(buckets[message[order[starts]]], size)
    rows, at = [], 0
    for b, n, s in zip(buckets.tolist(), sizes, table.column("shard").to_pylist(), strict=True):
        early = least[at : at + n] < doc[at : at + n]
        rows.append((b, s, squeeze(np.array([n], np.int64), np.packbits(early), least[at : at + n][early], home[at : at + n][early])))
        at += n
    return _rows(rows)


def _colours(bucket: Bucket, number: int, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The smallest document of each edge of the bucket, and its bucket."""
    _, doc, place = bucket.distinct(inverse=True)
    least = bucket.ids[doc].copy() if len(doc) else np.zeros(0, np.int64)
    home = np.full(len(least), number)
    at = 0
    for _, blob in sorted(zip(answers.column("shard").to_pylist(), answers.column("blob").to_pylist(), strict=True)):
        n, bits, ids, homes = expand(blob, np.int64, np.uint8, np.int64, np.int64)
        early = np.unpackbits(bits)[: n[0]].astype(bool)
        least[at : at + n[0]][early] = ids
        home[at : at + n[0]][early] = homes
        at += int(n[0])
    return (least[place], home[place]) if len(place) else (least, home)


class Paths:
    """The compacted paths of a bucket: runs of edges whose first document is an earlier one."""

    def __init__(self, bucket: Bucket, number: int, answers: pa.Table, single: set[bytes] = frozenset()):
        """single: paths that are to be cut into their edges."""
        self.bucket = bucket
        colour, home = _colours(bucket, number, answers)
        edge = np.flatnonzero(colour < bucket.ids[bucket.doc]) if len(colour) else np.zeros(0, np.int64)
        at, doc, source = bucket.at[edge], bucket.doc[edge], colour[edge]
        new = np.ones(len(edge), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1]) | (source[1:] != source[:-1])
        begin = np.flatnonzero(new)
        n = np.diff(np.append(begin, len(edge)))
        self.word, self.n, self.source, self.home, self.edge = at[begin], n, source[begin], home[edge][begin], bucket.edges[edge][begin]
        self.path = [self._name(*x) for x in zip(self.word.tolist(), n.tolist(), self.source.tolist(), self.edge.tolist(), strict=True)]
        if single:
            cut_ = np.array([p in single for p in self.path], bool)
            own = np.repeat(cut_, n)
            at, source, homes, edges = (x[own] for x in (at, source, home[edge], bucket.edges[edge]))
            one = np.ones(len(at), np.int64)
            self.path = [*compress(self.path, ~cut_), *(self._name(*x) for x in zip(at.tolist(), one.tolist(), source.tolist(), edges.tolist(), strict=True))]
            self.word, self.n, self.source, self.home, self.edge = (np.concatenate((x[~cut_], y)) for x, y in ((self.word, at), (self.n, one), (self.source, source), (self.home, homes), (self.edge, edges)))

    def _name(self, word: int, n: int, source: int, edge: int) -> bytes:
        return name_of(self.bucket.digest(word, n), n, source, edge)

    def rows(self, number: int, only: set[bytes] | None = None) -> pa.Table:
        """Each different path once."""
        first = {p: i for i, p in enumerate(self.path) if only is None or p in only}
        take = np.array(list(first.values()), np.int64)
        return pa.table([pa.array(np.full(len(take), number)), pa.array(list(first), pa.binary()), pa.array(self.home[take]), pa.array(self.source[take]), pa.array(self.edge[take].view(np.int64)), pa.array(self.n[take].astype(np.int32))], [c.split()[0] for c in _PATHS.split(", ")])


def name_of(digest: bytes, n: int, source: int, edge: int) -> bytes:
    return hashlib.blake2b(digest + n.to_bytes(8, "little") + source.to_bytes(8, "little", signed=True) + edge.to_bytes(8, "little"), digest_size=16).digest()


def _compact(k: int):
    def compact(key, docs, answers):
        number = key[0].as_py()
        return Paths(Bucket(docs.column("blob").to_pylist(), k), number, answers).rows(number)

    return compact


def _split(k: int):
    """The single edges of paths that didn't hold."""

    def split(key, docs, arrived):
        number, is_answer = key[0].as_py(), arrived.column("shard").to_numpy() >= 0
        failed = set(arrived.filter(pa.array(~is_answer)).column("blob").to_pylist())
        if not failed:
            return _EMPTY.empty_table()
        paths = Paths(Bucket(docs.column("blob").to_pylist(), k), number, arrived.filter(pa.array(is_answer)), failed)
        return paths.rows(number, {p for p, n in zip(paths.path, paths.n.tolist(), strict=True) if n == 1})

    return split


_EMPTY = pa.schema([("bucket", pa.int64()), ("path", pa.binary()), ("home", pa.int64()), ("source", pa.int64()), ("edge", pa.int64()), ("n", pa.int32())])


def _verify(k: int):
    """Which paths hold: at some place of the source, its first edge begins words with the same digest."""

    def verify(key, docs, asked):
        if not docs.num_rows or not asked.num_rows:
            return pa.table([pa.array([], pa.binary())], ["path"])
        bucket = Bucket(docs.column("blob").to_pylist(), k)
        order = np.argsort(bucket.edges, kind="stable")
        edges = bucket.edges[order]
        wanted = asked.column("edge").to_numpy().view(np.uint64)
        lo, hi = np.searchsorted(edges, wanted), np.searchsorted(edges, wanted, "right")
        held, seen = [], {}
        for i, (path, source, n, edge) in enumerate(zip(asked.column("path").to_pylist(), asked.column("source").to_pylist(), asked.column("n").to_pylist(), wanted.tolist(), strict=True)):
            for e in order[lo[i] : hi[i]].tolist():
                doc, word = int(bucket.doc[e]), int(bucket.at[e])
                if bucket.ids[doc] != source or word + n + k - 1 > bucket.first[doc + 1]:
                    continue
                digest = seen.get((word, n))
                if digest is None:
                    digest = seen[word, n] = bucket.digest(word, n)
                if name_of(digest, n, source, edge) == path:
                    held.append(path)
                    break
        return pa.table([pa.array(held, pa.binary())], ["path"])

    return verify


def _finish(k: int):
    def finish(key, docs, arrived):
        kind = arrived.column("shard").to_numpy()
        of = lambda which: set(arrived.filter(pa.array(kind == which)).column("blob").to_pylist())
        held, failed = of(-1), of(-2)
        bucket = Bucket(docs.column("blob").to_pylist(), k)
        paths = Paths(bucket, key[0].as_py(), arrived.filter(pa.array(kind >= 0)), failed)
        good = np.array([p in held for p in paths.path], bool)
        begin, close, source = paths.word[good], paths.word[good] + paths.n[good] + k - 1, paths.source[good]
        order = np.argsort(begin, kind="stable")
        begin, close, source = begin[order], close[order], source[order]
        cover = np.zeros(len(bucket.starts) + 1, np.int64)
        np.add.at(cover, begin, 1)
        np.add.at(cover, close, -1)
        gone = np.cumsum(cover)[:-1] > 0
        doc = np.searchsorted(bucket.first, begin, "right") - 1
        spans = pa.StructArray.from_arrays([pa.array(begin - bucket.first[doc]), pa.array(close - bucket.first[doc]), pa.array(source)], ["start", "end", "source"])
        each = np.searchsorted(doc, np.arange(len(bucket.ids) + 1)).astype(np.int32)
        kept, removed = [], []
        for i in range(len(bucket.ids)):
            words = bucket.raw[bucket.offsets[i] : bucket.offsets[i + 1]].split()
            lost = gone[bucket.first[i] : bucket.first[i + 1]]
            removed.append(n := int(lost.sum()))
            kept.append(b" ".join(compress(words, (~lost).tolist()) if n else words))
        return pa.table([id_column(bucket.ids), pa.array(np.diff(bucket.first), pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.ListArray.from_arrays(pa.array(each), spans)], ["doc_id", "n_words", "n_removed", "kept", "spans"])

    return finish


def dedup_substrings(docs: DataFrame, k: int = 13, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int | None = None, requests: int = REQUESTS) -> DataFrame:
    """One row for each document: n_words, n_removed, the kept words joined by spaces, and the removed spans with sources."""
    docs = picked(docs, id_col, text_col)
    plan = Plan(docs, bucket_bytes)
    by_bucket = bucketed(docs, plan)
    freed(docs.sparkSession)
    asked = by_bucket.mapInArrow(_ask(plan, k), _ASKED)
    answers = cut(asked.repartition(plan.shard_tasks, "shard").groupBy("shard").applyInArrow(_answer, _ASKED))
    freed(docs.sparkSession)
    together = lambda rows: by_bucket.repartition(plan.tasks, "bucket").groupBy("bucket").cogroup(rows.repartition(plan.tasks, "bucket").groupBy("bucket"))
    marked = lambda rows, mark: rows.select("bucket", F.lit(mark).alias("shard"), F.col("path").alias("blob"))

    def kept(rows: DataFrame) -> DataFrame:
        """cut(), and the shuffles behind it are given up at once: they hold the buckets' texts."""
        rows = cut(rows)
        freed(rows.sparkSession)
        return rows

    def verified(paths: DataFrame) -> DataFrame:
        """The paths (path) that hold, each different one verified once."""
        once = paths.groupBy("path").agg(F.first("home").alias("bucket"), F.first("source").alias("source"), F.first("edge").alias("edge"), F.first("n").alias("n"))
        hot = cut(once.groupBy("bucket").agg(F.ceil(F.count("*") / requests).cast("int").alias("copies")).where("copies > 1"))
        if hot.isEmpty():
            return kept(together(once).applyInArrow(_verify(k), "path binary"))
        copies = by_bucket.join(hot, "bucket", "left").select("bucket", "blob", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("copy"))
        dealt = once.join(hot, "bucket", "left").withColumn("copy", F.pmod(F.xxhash64("path"), F.coalesce("copies", F.lit(1))).cast("int")).drop("copies")
        return kept(copies.groupBy("bucket", "copy").cogroup(dealt.groupBy("bucket", "copy")).applyInArrow(_verify(k), "path binary"))

    paths = kept(together(answers).applyInArrow(_compact(k), _PATHS))
    held = verified(paths)
    good, failed = paths.join(held, "path", "left_semi"), kept(paths.join(held, "path", "left_anti"))
    known = answers.unionByName(marked(good, -1))
    if not failed.isEmpty():
        singles = kept(together(answers.unionByName(marked(failed, -2))).applyInArrow(_split(k), _PATHS))
        known = known.unionByName(marked(failed, -2)).unionByName(marked(singles.join(verified(singles), "path", "left_semi"), -1))
    return together(known).applyInArrow(_finish(k), OUTPUT)
