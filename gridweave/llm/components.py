"""Links within groups, and connected components over them, without a task that holds an unbounded group.

spanning() finds, for rows that share a key, links enough to connect all rows whose payloads match pairwise: each group is
walked breadth-first, comparing one row with all not reached yet, so a group of near copies costs a comparison or two for each row, and
no list of all pairs is ever made. A group above `limit` rows first compares every row with one leader (a join that Spark can
split); only rows that don't match it then meet all others, block by block. Every matching pair is thus either compared or already
connected through the leader.

connected() is the alternation of large-star and small-star steps (Kiveris et al., "Connected components in MapReduce and
beyond"): joins and minima only, a logarithmic number of rounds, each cut into the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cut, freed, lean, partitions

#: links(payloads) -> index pairs; links.two(payloads, payloads), if it has that, -> which of the one match those of the other: units of two rows are compared together
Linker = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def breadth_first(n: int, match: Callable[[int, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Stars (centre, row) that connect what a walk from each centre reaches; match(i, others) says which others are linked with i. A star's centre is its first row."""
    left, right = [], []
    open_ = np.arange(n)
    while len(open_) > 1:
        root = int(open_[0])
        queue, open_ = [root], open_[1:]
        while queue and len(open_):
            i = queue.pop()
            hit = match(i, open_)
            found = open_[hit]
            left += [root] * len(found)
            right += found.tolist()
            queue += found.tolist()
            open_ = open_[~hit]
    return np.array(left, np.int64), np.array(right, np.int64)


def _linked(units: DataFrame, keys: list[str], linker: Linker) -> DataFrame:
    """Links (a, b) of nodes (binary or long), found in each unit."""
    kind = _kind(units, "node")
    arrow = pa.int64() if kind == "bigint" else pa.binary()

    two, pairs = getattr(linker, "two", None), []

    def of(node: list, payload: list[bytes]):
        if len(set(node)) < len(node):  # a row that came twice
            node, payload = map(list, zip(*dict.fromkeys(zip(node, payload, strict=True)), strict=True))
        if len(node) < 2:
            return []
        if two and len(node) == 2:
            pairs.append((*node, *payload))
            return []
        i, j = linker(payload)
        return [(node[x], node[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)]

    def rows(links) -> pa.RecordBatch:
        if pairs:
            a, b, left, right = zip(*pairs, strict=True)
            links = links + [(a[k], b[k]) for k in np.flatnonzero(two(left, right)).tolist()]
            pairs.clear()
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], arrow), pa.array([y for _, y in links], arrow)], ["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]):
        last, node, payload, links = None, [], [], []
        for batch in batches:  # sorted, so that a unit's rows follow each other
            for *key, n, p in zip(*(batch.column(k).to_pylist() for k in (*keys, "node", "payload")), strict=True):
                if key != last:
                    links += of(node, payload)
                    last, node, payload = key, [], []
                node.append(n)
                payload.append(p)
            if links or pairs:
                yield rows(links)
                links = []
        yield rows(of(node, payload))

    n = partitions(units.sparkSession)
    return units.select(*keys, "node", "payload").repartition(n, *keys).sortWithinPartitions(*keys, "node").mapInArrow(lean(work), f"a {kind}, b {kind}")


def spanning(rows: DataFrame, sizes: DataFrame, linker: Linker, limit: int) -> DataFrame:
    """Links (a, b) from rows (key, node, payload); sizes: (key, n) of the keys that have two rows or more, a small frame."""
    large = sizes.where(F.col("n") > limit).select("key", "n")
    if large.isEmpty():
        return _linked(rows, ["key"], linker)
    # The first row of each large group is its leader; the join's other side can be split by Spark.
    leader = rows.join(large, "key").groupBy("key").agg(F.min_by(F.struct("node", "payload"), "node").alias("leader"))
    pairs = rows.join(leader, "key").select("key", "node", "payload", F.col("leader.node").alias("l"), F.col("leader.payload").alias("lp"))

    two = getattr(linker, "two", None)

    def compare(batches):
        for b in batches:
            node, payload, lead = (b.column(k).to_pylist() for k in ("node", "payload", "lp"))
            hit = two(payload, lead) if two and node else [len(linker([x, y])[0]) > 0 for x, y in zip(payload, lead, strict=True)]
            same = [x == y for x, y in zip(node, b.column("l").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("key", "node", "payload", "l")), pa.array(hit, pa.bool_()), pa.array(same, pa.bool_())], ["key", "node", "payload", "l", "hit", "same"])

    compared = cut(pairs.mapInArrow(lean(compare), f"key {_kind(rows, 'key')}, node {_kind(rows, 'node')}, payload binary, l {_kind(rows, 'node')}, hit boolean, same boolean"))
    stars = compared.where("hit and not same").select(F.col("node").alias("a"), F.col("l").alias("b"))
    rest = compared.groupBy("key").agg(F.count_if(F.expr("not hit and not same")).alias("missed"), F.count("*").alias("n")).where("missed > 0").select("key", F.ceil(F.col("missed") / limit).cast("int").alias("across"), F.ceil(F.col("n") / limit).cast("int").alias("down"))
    blocks = compared.join(rest, "key").withColumn("h", F.xxhash64("node"))
    missed = blocks.where("not hit and not same").select("key", "node", "payload", F.expr("cast(pmod(h, across) as int)").alias("i"), F.explode(F.expr("sequence(0, down - 1)")).alias("j"))
    others = blocks.select("key", "node", "payload", F.expr("cast(pmod(h, down) as int)").alias("j"), F.explode(F.expr("sequence(0, across - 1)")).alias("i"))
    small = rows.join(large, "key", "left_anti")
    return _linked(small, ["key"], linker).union(stars).union(_linked(missed.unionByName(others), ["key", "i", "j"], linker))


def _kind(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _stars(edges: DataFrame) -> bool:
    """Has each u one v, and is none of them a u?"""
    roles = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")), F.struct(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("parent")))).alias("r")).select("r.*")
    return roles.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent")).where("child > 1 or child + parent > 1").isEmpty()


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of an edge (a, b): the component's smallest node."""
    star = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while not _stars(star):
        both = star.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        # Cut, so that the join below is one of two plain shuffles, which Spark can split where a hub has very many edges.
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m")))
        large = star.join(least, "v").select("u", F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        star = cut(large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(smallest.select("u", F.col("m").alias("v"))).distinct())
        freed(star.sparkSession)
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).union(star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
