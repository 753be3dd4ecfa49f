"""Near-duplicate documents by a signature-coordinate inverted join.

A document's set is its distinct shingles of consecutive words; its signature the minima of 32 hash functions over the set. Documents with equal
sets are one class at once. Each class is posted under its (coordinate, value) pairs, an inverted list each. Two signatures that agree in
16 of 32 coordinates must share one of the 17 rarest of either, so only those postings are kept (prefix); the long lists are skipped
and take part only where collisions are counted, on the signatures themselves. Classes that agree in 16 coordinates, wherever
they share a kept list, form candidate groups; within these, full sets are compared, and a link is kept if 100 * |A & B| >= percent *
|A | B|. At a similarity of 0.8 fewer than 16 of 32 coordinates agree with a chance of about 3 in 100,000.

No list is expanded into pairs: lists and groups are walked by components.spanning(), which compares until all that is linked is
connected. Components come from distributed union-find. What is returned are memberships, not pairs.

Odd input: a document without words has no set, is linked with nothing and kept; one with fewer words than a shingle has its whole sequence
as its one element; null ids come last, and a group whose ids are all null has the component null and all of it kept (first tells one row); repeated rows are one class and the smallest id is
kept (all rows of that id); other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import LAST_ID, cut, lean, picked
from .components import breadth_first, connected, spanning
from .words import FOLD, grams, mix, scan_column

COORDINATES, MATCHES = 32, 16
#: Rows of a list or group that one task walks; above, see spanning(). In groups, so many shingles count as a row at least.
LIST_LIMIT, GROUP_LIMIT, SHINGLES_A_ROW = 20_000, 4_000, 1_000

_MULTIPLIERS = (mix(np.arange(1, 2 * 128 + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles, of the whole sequence if that is shorter."""
    return np.unique(grams(words, min(k, len(words)))) if len(words) else words


def signatures(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """A row of minima for each set (none empty)."""
    out = np.empty((len(sets), coordinates), np.uint32)
    if not sets:
        return out
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    x, y = np.empty_like(flat), np.empty_like(flat)  # in place: this loop is most of the work
    for c in range(coordinates):
        np.multiply(flat, _MULTIPLIERS[2 * c], out=x)
        np.right_shift(x, np.uint32(15), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, _MULTIPLIERS[2 * c + 1], out=x)
        out[:, c] = np.minimum.reduceat(x, starts)
    return out


def fingerprint(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def sets_of(column, k: int):
    """The shingle set of each text, in order."""
    for lo, hi, w in scan_column(column, fold=FOLD):
        for t in range(hi - lo):
            yield shingle_set(w.hashes[w.first[t] : w.first[t + 1]], k)


def by_signature(payloads: list[bytes], matches: int = MATCHES):
    s = np.frombuffer(b"".join(payloads), np.uint32).reshape(len(payloads), -1)
    return breadth_first(len(s), lambda i, others: (s[others] == s[i]).sum(1) >= matches)


def by_sets(payloads: list[bytes], percent: int = 80):
    """Links by full sets (payloads: their sorted hashes). By the triangle inequality of the Jaccard distance, rows at a distance above twice the limit
    from a row need no comparison with what is linked to it; sizes too far apart need none either."""
    sizes = np.array([len(p) // 8 for p in payloads], np.int64)
    _, flat = np.unique(np.frombuffer(b"".join(payloads), np.uint64), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    mark = np.zeros(int(flat.max(initial=-1)) + 1, bool)

    def match(i, others):
        out = np.zeros(len(others), bool)
        near = (100 * sizes[others] >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes[others])
        rows = others[near]
        if not len(rows):
            return out
        own = flat[starts[i] : starts[i + 1]]
        mark[own] = True
        n = sizes[rows]
        begin = np.cumsum(n) - n
        at = np.repeat(starts[rows] - begin, n) + np.arange(n.sum())
        both = np.add.reduceat(mark[flat[at]].astype(np.int64), begin)
        mark[own] = False
        out[near] = 100 * both >= percent * (sizes[i] + n - both)
        return out

    return breadth_first(len(sizes), match)


def _described(k: int):
    def describe(batches):
        for b in batches:
            sets = list(sets_of(b.column("text"), k))
            some = [s for s in sets if len(s)]
            rows = iter(signatures(some).tolist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary()), pa.array([np.array(next(rows), np.uint32).view(np.int32) if len(s) else None for s in sets], pa.list_(pa.int32()))], ["doc_id", "text_hash", "n_shingles", "node", "signature"])

    return describe


def prefix_postings(classes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """(key, node): each class under the rarest of its (coordinate, value) pairs, as many as it needs; pairs of one class only are left out."""
    keys = classes.select("node", F.explode(F.expr("transform(signature, (v, i) -> xxhash64(i, v))")).alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # The pairs that a class doesn't share are the rarest of all and come first in its prefix; of m shared pairs m - (matches - 1) are left for it.
    own = keys.join(shared, "key").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("all"))
    return own.where(F.size("all") >= matches).select("node", F.explode(F.expr(f"slice(all, 1, size(all) - {matches - 1})")).alias("p")).select(F.col("p.key").alias("key"), "node")


def sizes_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")


def near_duplicates(docs: DataFrame, shingle: int = 2, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", list_limit: int = LIST_LIMIT, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """One row for each document: n_shingles, component_id (the smallest id that links reach), kept (is it that id?), text_hash (xxhash64) and first (is it the row with the smallest id and text_hash? one row of a group, or such that repeat id and text, whatever the ids)."""
    docs = picked(docs, id_col, text_col)
    described = cut(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(lean(_described(shingle)), "doc_id long, text_hash long, n_shingles long, node binary, signature array<int>"))
    classes = described.where("node is not null").groupBy("node").agg(F.first("signature").alias("signature"), F.first("n_shingles").alias("size"), F.min(F.coalesce("doc_id", F.lit(LAST_ID))).alias("rep"))
    postings = cut(prefix_postings(classes))
    shared = sizes_of(postings)
    bytes_of = F.unhex(F.array_join(F.transform("signature", lambda v: F.lpad(F.hex(v.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")), ""))
    lists = postings.join(shared.select("key"), "key", "left_semi").join(classes.select("node", bytes_of.alias("payload")), "node").select("key", "node", "payload")
    groups = connected(spanning(lists, shared, by_signature, list_limit))
    members = cut(groups.join(classes.select("node", "rep", "size"), "node"))
    links = spanning(_with_sets(docs, members, shingle), members.groupBy(F.col("component").alias("key")).agg(F.greatest(F.count("*"), F.sum("size") / SHINGLES_A_ROW).cast("long").alias("n")), lambda p: by_sets(p, percent), group_limit)
    components = connected(links)
    labelled = cut(described.select("doc_id", "text_hash", "n_shingles", "node").join(components, "node", "left").withColumn("label", F.coalesce("component", "node")))
    row = F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "text_hash")
    least = cut(labelled.where("label is not null").groupBy("label").agg(F.min(row).alias("least")))
    joined = labelled.join(least, "label", "left")
    component = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.nullif(F.col("least.id"), F.lit(LAST_ID)))
    joined = joined.select("doc_id", "n_shingles", component.alias("component_id"), "text_hash", (F.col("label").isNull() | (row == F.col("least"))).alias("first"))
    return joined.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash", "first")


def _with_sets(docs: DataFrame, members: DataFrame, shingle: int) -> DataFrame:
    """(key, node, payload): the members of candidate groups with their full sets, from the texts of their representatives."""
    rows = docs.withColumn("rep", F.coalesce("doc_id", F.lit(LAST_ID))).drop("doc_id").join(members, "rep")

    def work(batches):
        for b in batches:
            sets = list(sets_of(b.column("text"), shingle))
            right = [len(s) > 0 and fingerprint(s) == n for s, n in zip(sets, b.column("node").to_pylist(), strict=True)]  # else another row of that id
            payload = pa.array([s.tobytes() if ok else None for s, ok in zip(sets, right, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("component"), b.column("node"), payload], ["key", "node", "payload"]).filter(pa.array(right, pa.bool_()))

    return rows.select("component", "node", "text").mapInArrow(lean(work), "key binary, node binary, payload binary")
