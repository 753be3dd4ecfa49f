"""Language-model scoring with an Elias-Fano n-gram trie.

Learning counts words and word pairs of all training documents. The trie has two levels. Level 1 holds the words' 64-bit
hashes, their counts, the quantised weight that a word as context gives to the lower order, and a monotone pointer to its
successors. Level 2 holds the successors of all contexts, each as a 32-bit value relative to its context, with a quantised
discounted probability. Words, pointers and successors are Elias-Fano sequences, read in place from one buffer or a memory-
mapped file; a pair is found by the successor search for (context's place, word) within the context's range.

The model is interpolated absolute discounting over add-one counts:
    P(w | c) = max(n(c, w) - D, 0) / n(c) + D * t(c) / n(c) * P1(w),   P1(w) = (n(w) + 1) / (N + V + 1),
with t(c) the distinct successors; a context never seen leaves P1 alone. The first word's context is a mark for the start.

The order is two. The trie is sharded by the hash of the context: each bucket of documents (see buckets.py) sends the words and pairs it has,
with its training counts, to the shards; a shard builds its part of the trie from all messages, writes it to a file of the task's own, maps it and answers each message from there. No
table is broadcast and each bucket sends a hot word once. What is gathered grows with the distinct pairs of the corpus.

Odd input: a null or empty text is one end token; a null id counts as text 'null' for the split and is returned as null;
repeated rows are learnt and scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import mmap
import struct
import tempfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import eliasfano
from .base import LAST_ID, cut, freed, picked
from .buckets import Plan, bucketed, expand, id_column, squeeze, unpack_texts
from .words import FOLD, pieces, scan

#: The part of each seen pair's count that goes to the lower order.
DISCOUNT = 0.75
#: Steps of the quantised log10 values; the last of them stands for a probability of zero. They reach down to 10^-16, below one in any count.
STEPS, LEVELS = 4096.0, 65535
END, START = np.uint64(0xE5D0_0000_0000_0001), np.uint64(0x57A2_7000_0000_0001)
_PAIR = np.uint64(32)
#: Words and pairs that a shard looks for at once.
ANSWERED = 1 << 20

OUTPUT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
_MESSAGE = "bucket long, shard int, blob binary"


def held_out(ids: np.ndarray, modulus: int = 7, remainder: int = 2) -> np.ndarray:
    return np.array([zlib.crc32(b"null" if i == LAST_ID else str(i).encode()) % modulus == remainder for i in ids.tolist()], bool)


def quantise(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.clip(np.rint(-np.log10(p) * STEPS), 0, LEVELS - 1), LEVELS).astype(np.uint16)


_VALUES = np.append(10.0 ** (-np.arange(LEVELS) / STEPS), 0.0)


class Trie:
    """One shard's levels in one buffer."""

    _HEAD = struct.Struct("<6Q")

    def __init__(self, buffer):
        sizes = self._HEAD.unpack_from(buffer, 0)
        at, parts = self._HEAD.size, []
        for n in sizes:
            parts.append(memoryview(buffer)[at : at + n])
            at += n
        self.words, self.pointers, self.successors = (eliasfano.EliasFano(p) for p in parts[:3])
        self.counts, self.weights, self.probabilities = (np.frombuffer(p, k) for p, k in zip(parts[3:], (np.int64, np.uint16, np.uint16), strict=True))

    @classmethod
    def build(cls, words: np.ndarray, counts: np.ndarray, context: np.ndarray, successor: np.ndarray, pairs: np.ndarray) -> Trie:
        """words ascending with counts (0 for mere contexts); pairs counted by (place of the context, successor), ascending."""
        t = np.bincount(context, minlength=len(words)).astype(np.int64)
        total = np.bincount(context, weights=pairs, minlength=len(words))
        weight = np.where(total > 0, DISCOUNT * t / np.maximum(total, 1), 1.0)
        probability = (pairs - DISCOUNT) / total[context]
        body = [eliasfano.encode(words), eliasfano.encode(np.concatenate(([0], np.cumsum(t))).astype(np.uint64)), eliasfano.encode(context.astype(np.uint64) << _PAIR | successor.astype(np.uint64)), counts.astype(np.int64).tobytes(), quantise(weight).tobytes(), quantise(probability).tobytes()]
        return cls(cls._HEAD.pack(*map(len, body)) + b"".join(body))._with(body)

    def _with(self, body) -> Trie:
        self._body = body
        return self

    def write(self, file) -> None:
        file.write(self._HEAD.pack(*map(len, self._body)) + b"".join(self._body))
        file.flush()

    @classmethod
    def mapped(cls, file) -> Trie:
        return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def save(self, path: str) -> None:
        with open(path, "wb") as f:
            self.write(f)

    @classmethod
    def open(cls, path: str) -> Trie:
        with open(path, "rb") as f:
            return cls.mapped(f)

    def find(self, words: np.ndarray) -> np.ndarray:
        """Places of words in level 1; -1 for those it doesn't have."""
        at = self.words.successor(words)
        ok = at < len(self.words)
        ok[ok] = self.words.get(at[ok]) == words[ok]
        return np.where(ok, at, -1)

    def pair(self, place: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Quantised probabilities of successors after the contexts at these places (LEVELS: none)."""
        out = np.full(len(place), LEVELS, np.uint16)
        known = np.flatnonzero(place >= 0)
        want = place[known].astype(np.uint64) << _PAIR | successor[known].astype(np.uint64)
        at = self.successors.successor(want)
        stop = self.pointers.get(place[known] + 1).astype(np.int64)  # the context's range ends here
        ok = np.flatnonzero(at < stop)
        ok = ok[self.successors.get(at[ok]) == want[ok]]
        out[known[ok]] = self.probabilities[at[ok]]
        return out


class Tokens:
    """The tokens of a bucket's documents: words and an end for each, with distinct words and pairs."""

    def __init__(self, blobs: list[bytes]):
        self.ids, data, offsets = unpack_texts(blobs)
        parts = [scan(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], fold=FOLD) for lo, hi in pieces(offsets)]
        words = np.concatenate([w.hashes for w in parts]) if parts else np.zeros(0, np.uint64)
        count = np.concatenate([np.diff(w.first) for w in parts]) if parts else np.zeros(0, np.int64)
        tokens = np.insert(words, np.cumsum(count), END)
        self.first = np.concatenate(([0], np.cumsum(count + 1)))
        contexts = np.concatenate(([START], tokens[:-1])) if len(tokens) else tokens
        contexts[self.first[:-1]] = START
        self.words, place = np.unique(np.concatenate((tokens, [START])).astype(np.uint64), return_inverse=True)
        self.token = place[:-1]
        before = np.concatenate(([place[-1]], self.token[:-1]))
        before[self.first[:-1]] = place[-1]
        self.pairs, self.pair = np.unique(before * np.int64(len(self.words)) + self.token, return_inverse=True)
        self.context, self.successor = np.divmod(self.pairs, len(self.words))
        self.held = held_out(self.ids)
        self.learns = np.repeat(~self.held, count + 1)


def _ask(plan: Plan):
    def ask(batches):
        for batch in batches:
            for number, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                t = Tokens([blob])
                counts = np.bincount(t.token[t.learns], minlength=len(t.words))
                seen = np.bincount(t.pair[t.learns], minlength=len(t.pairs))
                short = (t.words >> _PAIR).astype(np.uint32)
                rows = []
                for s, lo, hi in plan.shard_ranges(t.words):
                    a, b = np.searchsorted(t.context, (lo, hi))
                    # Successors of one context ascend with the word's place, as their upper 32 bits do.
                    code = eliasfano.encode((t.context[a:b] - lo).astype(np.uint64) << _PAIR | short[t.successor[a:b]].astype(np.uint64))
                    rows.append((number, s, squeeze(np.frombuffer(eliasfano.encode(t.words[lo:hi]), np.uint8), counts[lo:hi].astype(np.int64), np.frombuffer(code, np.uint8), seen[a:b].astype(np.int32))))
                yield from _rows(rows).to_batches()

    return ask


def _rows(rows, more=()) -> pa.Table:
    return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary()), *more], ["bucket", "shard", "blob", "n", "v"][: 3 + len(more)])


def _answer(table: pa.Table) -> pa.Table:
    """Builds the shard's trie from all messages, then answers each; n and v (on the first row): tokens and distinct tokens."""
    shard, buckets = table.column("shard")[0].as_py(), table.column("bucket").to_pylist()
    asked = []
    for blob in table.column("blob").to_pylist():
        words, counts, code, seen = expand(blob, np.uint8, np.int64, np.uint8, np.int32)
        asked.append((eliasfano.EliasFano(words).decode(), counts, eliasfano.EliasFano(code).decode(), seen))
    del table
    every = np.unique(np.concatenate([a[0] for a in asked]))
    counts = np.zeros(len(every), np.int64)
    keys, number = [], []
    for words, n, pairs, seen in asked:
        place = np.searchsorted(every, words)
        counts[place] += n
        learnt = seen > 0
        keys.append(place[(pairs[learnt] >> _PAIR).astype(np.int64)].astype(np.uint64) << _PAIR | pairs[learnt] & np.uint64(0xFFFFFFFF))
        number.append(seen[learnt])
    key, number = np.concatenate(keys), np.concatenate(number)
    del keys
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    number = np.add.reduceat(number[order].astype(np.int64), begin) if len(key) else number
    key = key[begin]
    context = (key >> _PAIR).astype(np.int64)
    trained = (counts > 0) | (np.bincount(context, minlength=len(every)) > 0)
    rank = np.cumsum(trained) - 1
    trie = Trie.build(every[trained], counts[trained], rank[context], key & np.uint64(0xFFFFFFFF), number)
    total, kinds = int(counts.sum()), int((counts > 0).sum())
    del every, counts, key, number, context, rank, trained
    with tempfile.TemporaryFile() as file:  # gone when the shard has answered
        trie.write(file)
        trie = Trie.mapped(file)
        rows = _answers(trie, shard, buckets, asked)
    first = [k == 0 for k in range(len(rows))]
    return _rows(rows, [pa.array([total * f for f in first], pa.int64()), pa.array([kinds * f for f in first], pa.int64())])


def _together(sizes: list[int]) -> list[tuple[int, int]]:
    """(first message, end) of messages that are answered together: ANSWERED entries at most, or a single message."""
    out, lo, n = [], 0, 0
    for k, size in enumerate(sizes):
        if k > lo and n + size > ANSWERED:
            out.append((lo, k))
            lo, n = k, 0
        n += size
    return [*out, (lo, len(sizes))]


def _answers(trie: Trie, shard: int, buckets: list[int], asked: list) -> list[tuple]:
    """Many messages' questions go through the trie in one ascending order, so that it is read part by part, however few each message has."""
    rows = []
    for lo, hi in _together([len(a[0]) + len(a[2]) for a in asked]):
        own = asked[lo:hi]
        words, pairs = np.concatenate([a[0] for a in own]), np.concatenate([a[2] for a in own])
        first, first_pair = (np.cumsum([0] + [len(a[k]) for a in own]) for k in (0, 2))
        order = np.argsort(words, kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = trie.find(words[order])
        known = place >= 0
        n = np.where(known, trie.counts[place] if len(trie.counts) else 0, 0).astype(np.int64)
        weight = np.where(known, trie.weights[place] if len(trie.weights) else 0, 0).astype(np.uint16)
        context, short = place[np.repeat(first[:-1], np.diff(first_pair)) + (pairs >> _PAIR).astype(np.int64)], (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        order = np.argsort((context + 1).astype(np.uint64) << _PAIR | short.astype(np.uint64), kind="stable")
        q = np.empty(len(pairs), np.uint16)
        q[order] = trie.pair(context[order], short[order])
        for k, b in enumerate(buckets[lo:hi]):
            w, p = slice(first[k], first[k + 1]), slice(first_pair[k], first_pair[k + 1])
            rows.append((b, shard, squeeze(n[w], weight[w], q[p])))
    return rows


def _score(total: int, vocabulary: int):
    def score(key, docs, answers):
        t = Tokens(docs.column("blob").to_pylist())
        parts = [expand(b, np.int64, np.uint16, np.uint16) for _, b in sorted(zip(answers.column("shard").to_pylist(), answers.column("blob").to_pylist(), strict=True))]
        counts, weight, q = (np.concatenate(x) for x in zip(*parts, strict=True))
        one = (counts + 1) / (total + vocabulary + 1)
        log = np.log10(one)
        p = _VALUES[q] + _VALUES[weight[t.context]] * one[t.successor]
        base = np.add.reduceat(log[t.token], t.first[:-1])
        model = np.add.reduceat(np.log10(p)[t.pair], t.first[:-1])
        known = np.add.reduceat((counts > 0)[t.token].astype(np.int64), t.first[:-1])
        return pa.table([id_column(t.ids), pa.array(t.held), pa.array(np.diff(t.first), pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(model)], [x.split()[0] for x in OUTPUT.split(", ")])

    return score


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int | None = None) -> DataFrame:
    """One row for each document: held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities)."""
    docs = picked(docs, id_col, text_col)
    plan = Plan(docs, bucket_bytes)
    by_bucket = bucketed(docs, plan)
    freed(docs.sparkSession)
    asked = by_bucket.mapInArrow(_ask(plan), _MESSAGE)
    answers = cut(asked.repartition(plan.shard_tasks, "shard").groupBy("shard").applyInArrow(_answer, f"{_MESSAGE}, n long, v long"))
    freed(docs.sparkSession)
    total, vocabulary = (int(x or 0) for x in answers.agg(F.sum("n"), F.sum("v")).first())
    answers = answers.drop("n", "v").repartition(plan.tasks, "bucket")
    scored = by_bucket.repartition(plan.tasks, "bucket").groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(_score(total, vocabulary), OUTPUT)
    return scored.withColumn("train_tokens", F.lit(total).cast("long"))
