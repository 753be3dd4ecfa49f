"""Toxicity by a convolutional text classifier in numpy.

A word's embedding is the sum of three hashed rows: its own hash and those of its first 5 and first 8 bytes, so inflected
forms share what they have in common. Filters over 1, 2 and 3 words, max pooling over the whole text and one linear layer give a logit.
The classifier learns with Adagrad from all labelled rows. They are dealt by their ids' hashes to shards of about SHARD_ROWS, whatever the partitions; in each of
EPOCHS rounds every shard learns from all its rows on an executor, starting from the same net, and the shards' moves are averaged, each number
weighted by what the shard added to its Adagrad sum. A quarter of the labelled rows is kept apart: all of them calibrate the logit to a
probability (Platt scaling) and set a threshold for each language, the one with the best F1 there; a language with few labelled rows takes the
threshold of all. For that the driver gets counts of logits, to the nearest 1/LOGIT_STEPS. Scores never see language, source or id.

All texts are scored whole, in one pass without a shuffle; the executors get the model's tables, whose size is fixed.

Odd input: null and empty texts have no words and get the score of a text without any signal; labels that repeat an id count as toxic if
one of them does, null labels are ignored; without labels of both classes all scores are the share of toxic labels; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cut, freed, lean, partitions, ship
from .lines import bitmap, in_bitmap
from .words import ALNUM, FOLD, Words, mix, scan_column, span_hashes

MOST_POSITIVE, MOST_NEGATIVE, MOST_SAMPLE_BYTES = 3000, 5000, 64 << 20
ROWS, DIM, FILTERS, WIDTHS, PREFIXES = 1 << 16, 12, 8, (1, 2, 3), (5, 8)
EPOCHS, BATCH, RATE = 8, 32, 0.1
#: Learning rows of a shard, words that it holds at once (one row at least), numbers of the net that travel as one row, parts of a logit, and the greatest logit.
SHARD_ROWS, CHUNK_WORDS, BLOCK, LOGIT_STEPS, MOST_LOGIT = 4000, 1 << 21, 1 << 14, 256, 40
#: The decision on calibrated scores, and the labelled rows of a class that a language's own threshold needs.
THRESHOLD, LEAST_LABELS = 0.3, 12


def features(w: Words) -> np.ndarray:
    """Row numbers of the embedding, three for each word."""
    kinds = [w.hashes] + [span_hashes(w.data, w.starts, np.minimum(w.ends, w.starts + n)) for n in PREFIXES]
    return np.stack([(mix(h + np.uint64(k)) % np.uint64(ROWS)).astype(np.int32) for k, h in enumerate(kinds)], 1) if len(w.starts) else np.zeros((0, 3), np.int32)


def feature_rows(column):
    """The features of each text, in order."""
    for lo, hi, w in scan_column(column, ALNUM, FOLD):
        f = features(w)
        for t in range(hi - lo):
            yield f[w.first[t] : w.first[t + 1]]


@dataclass
class Net:
    table: np.ndarray
    filters: list[np.ndarray]  # for each width: (width, DIM, FILTERS)
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = THRESHOLD

    @classmethod
    def new(cls, seed: int = 7) -> Net:
        r = np.random.default_rng(seed)
        scale = lambda *shape: (r.standard_normal(shape) * 0.1).astype(np.float32)
        return cls(scale(ROWS, DIM), [scale(k, DIM, FILTERS) * 3 for k in WIDTHS], np.abs(scale(len(WIDTHS) * FILTERS)) + 0.1, -2.0)

    def pooled(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For texts (their words' features): the pooled filters of each, where each filter is largest, all texts' features one after another, their embeddings."""
        rows = np.concatenate([*texts, np.zeros((0, 1 + len(PREFIXES)), np.int32)])
        first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        e = self.table[rows].sum(1)
        pool, peak = np.zeros((len(texts), len(WIDTHS) * FILTERS), np.float32), np.zeros((len(texts), len(WIDTHS) * FILTERS), np.int64)
        for k, (width, f) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            m = len(e) - width + 1
            if m <= 0:
                continue
            out = sum(e[j : j + m] @ f[j] for j in range(width))
            for b in range(1, width):  # windows that leave their text
                at = first[1:-1] - b
                out[at[(at >= 0) & (at < m)]] = -1
            some = np.flatnonzero((np.diff(first) > 0) & (first[:-1] < m))
            begin = first[some]
            most = np.maximum.reduceat(out, begin)
            size = np.diff(np.append(begin, m))
            there = np.where(out == np.repeat(most, size, axis=0), np.arange(m)[:, None], m)
            own = slice(k * FILTERS, (k + 1) * FILTERS)
            pool[some, own], peak[some, own] = np.maximum(most, 0), np.minimum.reduceat(there, begin)
        return pool, peak, rows, e

    def flat(self) -> np.ndarray:
        """All that is learnt, one after another."""
        return np.concatenate([*(p.ravel() for p in (self.table, *self.filters, self.weights)), [self.bias]]).astype(np.float32)

    def put(self, flat: np.ndarray) -> None:
        for p, own in zip((self.table, *self.filters, self.weights), self.parts(flat), strict=False):
            p[:] = own
        self.bias = float(flat[-1])

    def parts(self, flat: np.ndarray) -> list[np.ndarray]:
        """Views of such numbers in the shapes of table, filters, weights and bias."""
        shapes = [p.shape for p in (self.table, *self.filters, self.weights)] + [(1,)]
        ends = np.cumsum([np.prod(x) for x in shapes])
        return [x.reshape(shape) for x, shape in zip(np.split(flat, ends[:-1]), shapes, strict=True)]

    def learn(self, texts: list[np.ndarray], labels: np.ndarray, gain: list[np.ndarray], seed: int) -> None:
        """Sees each text once; a batch is a few array operations. gain: Adagrad's sums, as of parts()."""
        gain_bias = gain[-1]
        order = np.random.default_rng(seed).permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            own = order[lo : lo + BATCH]
            pool, peak, features_, e = self.pooled([texts[i] for i in own])
            g = (1 / (1 + np.exp(-(pool @ self.weights + self.bias))) - labels[own]).astype(np.float32)
            d_filters, touched, moves = [np.zeros_like(f) for f in self.filters], [], []
            for k, (width, f) in enumerate(zip(WIDTHS, self.filters, strict=True)):
                i, c = np.nonzero(pool[:, k * FILTERS : (k + 1) * FILTERS] > 0)
                at, step = peak[i, k * FILTERS + c], (g[i] * self.weights[k * FILTERS + c])[:, None]
                for j in range(width):
                    np.add.at(d_filters[k][j].T, c, step * e[at + j])
                    touched.append(features_[at + j].ravel())
                    moves.append(np.repeat(step * f[j][:, c].T, features_.shape[1], 0))
            d_weights, d_bias = g @ pool, float(g.sum())
            for p, d, s in zip((*self.filters, self.weights), (*d_filters, d_weights), gain[1:-1], strict=True):
                s += d * d
                p -= RATE / 2 * d / np.sqrt(s)
            gain_bias += d_bias**2
            self.bias -= RATE / 2 * d_bias / float(np.sqrt(gain_bias[0]))
            rows, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            if len(rows):
                d = np.zeros((len(rows), DIM), np.float32)
                np.add.at(d, inverse, np.concatenate(moves))
                gain[0][rows] += d * d
                self.table[rows] -= RATE * d / np.sqrt(gain[0][rows])

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        found = [self.pooled(texts[lo : lo + BATCH])[0] @ self.weights + self.bias for lo in range(0, len(texts), BATCH)]
        return np.concatenate(found).astype(np.float64) if found else np.zeros(0)

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * logits + self.offset)))

    def calibrate(self, logits: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> None:
        """Weighted logistic regression of the labels on the logit, by Newton steps with a little ridge."""
        a = np.array([1.0, 0.0])
        x = np.stack([logits, np.ones_like(logits)], 1)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
            gradient = x.T @ (weight * (p - labels)) + 1e-2 * (a - [1, 0])
            a -= np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2), gradient)
        self.slope, self.offset = max(1e-3, float(a[0])), float(a[1])


class Scorer:
    """The net with its filters multiplied into the table: a text is scored by lookups, sums and maxima."""

    def __init__(self, net: Net):
        self.net = net
        self.tables = [[(net.table @ f[j]).astype(np.float32) for j in range(width)] for width, f in zip(WIDTHS, net.filters, strict=True)]

    def scores(self, column) -> np.ndarray:
        found = []
        for lo, hi, w in scan_column(column, ALNUM, FOLD):
            rows, n, pools = features(w), np.diff(w.first), []
            for width, tables in zip(WIDTHS, self.tables, strict=True):
                pool = np.zeros((hi - lo, FILTERS), np.float32)
                m = len(rows) - width + 1
                if m > 0:
                    out = sum(t[rows[j : j + m, c]] for j, t in enumerate(tables) for c in range(rows.shape[1]))
                    for b in range(1, width):  # windows that leave their text
                        at = w.first[1:-1] - b
                        out[at[(at >= 0) & (at < m)]] = 0
                    some = np.flatnonzero((n > 0) & (w.first[:-1] < m))
                    pool[some] = np.maximum(np.maximum.reduceat(out, w.first[some]), 0)
                pools.append(pool)
            found.append(self.net.probability((np.concatenate(pools, 1) @ self.net.weights + self.net.bias).astype(np.float64)))
        return np.concatenate(found) if found else np.zeros(0)


def sampled(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple], dict[int, int]]:
    """Some labelled rows to look at on the driver, bounded by rows and bytes (text, toxic, lang, in the calibration part?), and how many there are of each class. trained() doesn't use them: it learns from all."""
    own = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("y")).where("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y"))
    own = own.withColumn("h", F.xxhash64(F.col("id"), F.lit(7))).cache()
    try:
        counts = {int(r.y > 0): int(r["count"]) for r in own.groupBy((F.col("y") > 0).cast("int").alias("y")).count().collect()}
        some = own.where("y > 0").orderBy("h").limit(MOST_POSITIVE).union(own.where("y <= 0").orderBy("h").limit(MOST_NEGATIVE))
        texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).join(F.broadcast(some), "id")
        # Of rows that repeat an id one counts: the one with the smallest hash.
        sizes = texts.groupBy("id", "h").agg(F.min(F.struct(F.xxhash64("text").alias("t"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"))).alias("x")).select("id", "h", "x.t", "x.n").collect()  # the sample's bound holds here
        sizes.sort(key=lambda r: (r.h, r.id))
        room = [k == 0 or n <= MOST_SAMPLE_BYTES for k, n in enumerate(accumulate(r.n for r in sizes))]
        wanted = docs.sparkSession.createDataFrame([(r.id, r.t) for r, ok in zip(sizes, room, strict=True) if ok], "id long, t long")
        rows = texts.join(F.broadcast(wanted), (texts["id"] == wanted["id"]) & F.xxhash64("text").eqNullSafe(wanted["t"])).select(texts["id"], "text", "y", "lang", "h").groupBy("id").agg(F.min(F.struct("text", "y", "lang", "h")).alias("r")).select("id", "r.*").collect()
    finally:
        own.unpersist()
    rows.sort(key=lambda r: (r.h, r.id))
    return [(r.text, int(r.y > 0), r.lang, (r.h >> 7) % 4 == 0) for r in rows], counts


_ROW = "id long, t long, lang string, f binary"


def _labelled(docs: DataFrame, own: DataFrame, shards: int) -> DataFrame:
    """Every labelled row: shard, h, y, lang, apart and f (its features, packed), in the shared folder. Rows without a label stay behind, most of them at a bitmap of fixed size before anything is shuffled."""
    ship(docs.sparkSession)
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(own.select(F.xxhash64("id"))))

    def find(batches):
        for b in batches:
            b = b.filter(pa.array(in_bitmap(wanted.value, b.column("h").to_numpy()), pa.bool_()))
            if b.num_rows:
                found = [zlib.compress(f.astype(np.uint16).tobytes(), 1) for f in feature_rows(b.column("text"))]
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("t"), b.column("lang"), pa.array(found, pa.binary())], ["id", "t", "lang", "f"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("id is not null")
    rows = rows.select("id", F.xxhash64("id").alias("h"), F.xxhash64("text").alias("t"), "lang", "text").mapInArrow(lean(find), _ROW)
    # Of rows that repeat an id one counts: the one with the smallest hash.
    once = rows.groupBy("id").agg(F.min(F.struct("t", "lang", "f")).alias("r"))
    found = once.join(own, "id").select(F.pmod("h", F.lit(shards)).alias("shard"), "id", "h", (F.col("y") > 0).cast("int").alias("y"), "r.lang", (F.pmod(F.shiftright("h", 7), F.lit(4)) == 0).alias("apart"), "r.f")
    return cut(found.repartition(max(shards, partitions(docs.sparkSession)), "shard").sortWithinPartitions("shard", "h", "id"))


def _unpacked(f: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(f), np.uint16).astype(np.int32).reshape(-1, 1 + len(PREFIXES))


def _chunks(rows: Iterator[tuple]) -> Iterator[tuple[list[np.ndarray], list]]:
    """(features, the rest) of rows in a row, as many as may be held at once."""
    texts, rest, n = [], [], 0
    for f, *other in rows:
        texts.append(_unpacked(f))
        rest.append(other)
        n += len(texts[-1])
        if n >= CHUNK_WORDS:
            yield texts, rest
            texts, rest, n = [], [], 0
    if texts:
        yield texts, rest


def _round(shared, k: int):
    """What a shard's rows change in the net: shard, block, moves and additions to Adagrad's sums."""

    def work(batches):
        flat, sums = shared.value
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("shard", "f", "y")), strict=True))
        for shard, own in groupby(rows, key=lambda r: r[0]):
            net, gain = Net.new(), sums.copy()
            net.put(flat)
            for c, (texts, y) in enumerate(_chunks(r[1:] for r in own)):
                net.learn(texts, np.array(y, np.float64)[:, 0], net.parts(gain), 11 + 1009 * k + c)
            moves, added = net.flat() - flat, gain - sums
            for lo in range(0, len(flat), BLOCK):
                if added[lo : lo + BLOCK].any():
                    yield pa.RecordBatch.from_pydict({"shard": [shard], "block": pa.array([lo], pa.int32()), "moves": [moves[lo : lo + BLOCK].tobytes()], "added": [added[lo : lo + BLOCK].tobytes()]})

    return work


def _averaged(t: pa.Table) -> pa.Table:
    """A block's moves and additions of all shards, each number weighted by the shard's addition to it."""
    total = move = more = 0.0
    for i in np.argsort(t.column("shard").to_numpy()).tolist():  # the order of sums, whatever the partitions
        w = np.frombuffer(t.column("added")[i].as_py(), np.float32).astype(np.float64)
        total, move, more = total + w, move + w * np.frombuffer(t.column("moves")[i].as_py(), np.float32), more + w * w
    some = np.where(total > 0, total, 1)
    return pa.table({"block": t.column("block")[:1], "moves": [(move / some).astype(np.float32).tobytes()], "added": [(more / some).astype(np.float32).tobytes()]})


def _logits(shared):
    def work(batches):
        for b in batches:
            for texts, rest in _chunks(zip(*(b.column(c).to_pylist() for c in ("f", "lang", "y")), strict=True)):
                z = np.rint(np.clip(shared.value.logits(texts), -MOST_LOGIT, MOST_LOGIT) * LOGIT_STEPS)
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rest], pa.string()), pa.array([r[1] for r in rest], pa.int32()), pa.array(z.astype(np.int32))], ["lang", "y", "z"])

    return work


def trained(docs: DataFrame, labels: DataFrame) -> Net:
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    own = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("y")).where("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y"))
    own = own.withColumn("h", F.xxhash64(F.col("id"), F.lit(7)))
    counts = {int(r.y): int(r["count"]) for r in own.groupBy((F.col("y") > 0).cast("int").alias("y")).count().collect()}
    net = Net.new()
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    rows = _labelled(docs, own, max(1, -(-sum(counts.values()) // SHARD_ROWS)))
    there = {(r.apart, r.y) for r in rows.select("apart", "y").distinct().collect()}
    if len(there) < 4:
        net.weights[:] = 0
        net.bias = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return net
    flat = net.flat()
    gain = np.full_like(flat, 1e-2)
    for k in range(EPOCHS):
        shared = send((flat, gain))
        moved = rows.where("not apart").select("shard", "f", "y").mapInArrow(lean(_round(shared, k)), "shard long, block int, moves binary, added binary")
        t = moved.groupBy("block").applyInArrow(_averaged, "block int, moves binary, added binary").toArrow()  # the net's size
        flat, gain = flat.copy(), gain.copy()
        for lo, moves, added in zip(*(t.column(c).to_pylist() for c in ("block", "moves", "added")), strict=True):
            flat[lo : lo + BLOCK] += np.frombuffer(moves, np.float32)
            gain[lo : lo + BLOCK] += np.frombuffer(added, np.float32)
        shared.destroy()
    net.put(flat)
    z = rows.where("apart").select("f", "lang", "y").mapInArrow(lean(_logits(send(net))), "lang string, y int, z int")
    z = cut(z.groupBy("lang", "y", "z").count())
    fit = lambda found: (net.probability(found[0]), *found[1:])
    found = _counted(z.groupBy("y", "z").agg(F.sum("count").alias("count")))
    net.calibrate(found[0], found[1], found[2] * np.where(found[1] == 1, share / np.average(found[1], weights=found[2]), (1 - share) / np.average(1 - found[1], weights=found[2])))
    net.threshold = best_threshold(*fit(found))
    enough = z.groupBy("lang").agg(F.sum(F.col("count") * (F.col("y") == 1).cast("long")).alias("p"), F.sum("count").alias("n")).where(f"lang is not null and p >= {LEAST_LABELS} and n - p >= {LEAST_LABELS}")
    for lang in sorted(r.lang for r in enough.collect()):
        net.thresholds[lang] = best_threshold(*fit(_counted(z.where(F.col("lang") == lang))))
    del rows, z
    freed(spark)
    return net


def _counted(z: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits, labels and numbers of rows, in a fixed order; at most a row for each class and step of a logit."""
    t = z.select("z", "y", F.col("count").cast("double").alias("n")).orderBy("z", "y").toArrow()
    return t.column("z").to_numpy() / LOGIT_STEPS, t.column("y").to_numpy().astype(np.float64), t.column("n").to_numpy()


def best_threshold(p: np.ndarray, t: np.ndarray, weight: np.ndarray) -> float:
    """Midway between scores, where the weighted F1 is best."""
    order = np.argsort(-p, kind="stable")
    hit, all_ = np.cumsum((weight * t)[order]), np.cumsum(weight[order])
    f1 = 2 * hit / (all_ + (weight * t).sum())
    last = np.append(np.diff(p[order]) != 0, True)  # equal scores stay together
    k = int(np.argmax(np.where(last, f1, -1)))
    low = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + low) / 2)


def score(docs: DataFrame, net: Net) -> DataFrame:
    """doc_id, score, threshold (of the row's language) and flagged."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def work(batches):
        scorer = Scorer(shared.value)
        for b in batches:
            p = scorer.scores(b.column("text"))
            limit = np.array([shared.value.thresholds.get(x, shared.value.threshold) for x in b.column("lang").to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p), pa.array(limit), pa.array(p >= limit, pa.bool_())], ["doc_id", "score", "threshold", "flagged"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    return rows.mapInArrow(lean(work), "doc_id long, score double, threshold double, flagged boolean")


def drop_toxic(docs: DataFrame, net: Net) -> DataFrame:
    """The documents below their language's threshold, with all their columns; nothing is shuffled."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def keep(batches):
        scorer = Scorer(shared.value)
        for b in batches:
            limit = np.array([shared.value.thresholds.get(x, shared.value.threshold) for x in b.column("lang").to_pylist()], np.float64)
            yield b.filter(pa.array(scorer.scores(b.column("text")) < limit, pa.bool_()))

    return docs.mapInArrow(lean(keep), docs.schema)
