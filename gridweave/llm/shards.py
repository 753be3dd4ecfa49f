"""Sharding by balanced label propagation, in DataFrame operations only.

Documents that are linked should share a shard, and shards should be even. Documents start dealt out evenly by a hash, whatever their links. In each round
every document counts its neighbours' shards by a join; one that has more neighbours elsewhere asks to move there. Between two shards as many
may move as ask for the opposite way, and each shard admits others while it is below its quota and SLACK, the largest gains first; the last
places of a gain go by a hash. Where more ask than that, documents without links make room: drawn by a hash, they go the opposite way, which cuts nothing. A round's half of the documents, drawn by a hash, may move, so that neighbours don't swap places for ever. At last every shard gets exactly its quota:
surplus documents leave full shards, those first whose move cuts no or few links, and fill the others' room in runs, so that documents of a split
group stay together.

Quotas need ranks within shards. rank() gives them without sorting a shard in one task: counts by (shard, slice of the order) are
summed up in a table of fixed size, and only slices are sorted.

Hot groups: links form stars around one document of a group, so a group of any size has as many links as documents; neighbours'
shards are counted by sums that combine before the shuffle (a hub has at most `shards` partial sums for each task), and where many documents
ask for one's shard, its row is repeated for each SPLIT of them and they are dealt over the copies.

All choices follow from hashes of id and text, none from the input's partitions or files; rows that agree in both are interchangeable.

Odd input: a null text is empty, null and empty texts link with each other as equal texts do; a null id is hashed like any other; repeated rows are
rows of their own (equal texts); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import cut, freed, partitions

SHARDS, ROUNDS = 8, 6
#: How far above its quota a shard may be between rounds, as a share of it.
SLACK = 0.02
#: Slices of an order in which rows are ranked; their counts are a table of at most shards * SLICES rows.
SLICES = 4096
#: Links from which on a group's documents are ranked in several slices, not as one run, and a node's shard is handed out by several rows.
SPLIT = 1000


def rank(df: DataFrame, group: str, slice_of: Column, order: list[Column], name: str) -> DataFrame:
    """Adds the row's place (from 0) in its group, in the order of (slice, order...). slice_of: an int below 4 * SLICES, ascending with the order wanted."""
    df = df.withColumn("_slice", slice_of)
    sizes = df.groupBy(group, "_slice").agg(F.count("*").alias("_n"))  # at most groups * 4 * SLICES rows, whatever the input
    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)))
    before = F.broadcast(before.select(F.col(group).alias("_g"), F.col("_slice").alias("_s"), F.coalesce("_before", F.lit(0)).alias("_before")))
    own = Window.partitionBy(group, "_slice").orderBy(*order)
    return df.withColumn("_own", F.row_number().over(own) - 1).join(before, (F.col(group) == F.col("_g")) & (F.col("_slice") == F.col("_s"))).withColumn(name, (F.col("_own") + F.col("_before")).cast("long")).drop("_g", "_s", "_slice", "_own", "_before")


def _sliced(x: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(x, F.lit(seed)), F.lit(SLICES)).cast("int")


def quotas(n: int, shards: int) -> list[int]:
    return [n // shards + (k < n % shards) for k in range(shards)]


def _array(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _counts(state: DataFrame, shards: int) -> list[int]:
    found = {r.shard: r["count"] for r in state.groupBy("shard").count().collect()}  # one row for each shard
    return [found.get(k, 0) for k in range(shards)]


def _salts(weight: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(weight / SPLIT)).cast("int")


def propagate(nodes: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(node, h, weight, hub, shard) for nodes (node long; h: a hash that orders them; weight: links it has; hub: what runs of them go by; seat: its first shard, or null) and links (a, b, b's weight bw), each
    in both directions; shards' counts differ by one at most."""
    quota = quotas(nodes.count(), shards)
    tasks = partitions(nodes.sparkSession)
    # Dealt as the rounds need them, and kept so: a round moves the told shards, the votes, and nothing else.
    links = cut(links.select("a", "b", F.pmod(F.xxhash64("a", F.lit(4)), _salts(F.col("bw"))).cast("int").alias("salt")).repartition(tasks, "b", "salt"))
    state = cut(nodes.select("node", "h", "weight", "hub", F.coalesce("seat", F.pmod(F.xxhash64("h", F.lit(3)), F.lit(shards))).cast("int").alias("shard")).repartition(tasks, "node"))
    for turn in range(rounds):
        told = state.where("weight > 0").select(F.col("node").alias("b"), "shard", F.explode(F.sequence(F.lit(0), _salts(F.col("weight")) - 1)).alias("salt"))
        votes = links.join(told, ["b", "salt"]).groupBy(F.col("a").alias("node")).agg(F.array(*[F.count_if(F.col("shard") == k) for k in range(shards)]).alias("votes"))
        best = F.array_max("votes")
        gain = F.coalesce(best - F.get("votes", F.col("shard")), F.lit(0))
        joined = state.join(votes, "node", "left").select(*state.columns, (F.array_position("votes", best) - 1).cast("int").alias("best"), gain.alias("gain"))
        asks = (F.col("gain") > 0) & (F.pmod(F.xxhash64("h", F.lit(100 + turn)), F.lit(2)) == 0)
        joined = cut(joined.withColumns({"to": F.when(asks, F.col("best")), "gain_class": F.when(asks, F.least(F.lit(62), F.floor(F.log2(F.col("gain").cast("double")))).cast("int"))}).drop("best", "gain"))
        found = joined.groupBy("shard", "to", "gain_class").agg(F.count("*").alias("n"), F.count_if(F.col("weight") == 0).alias("alone")).collect()  # 63 rows for each two shards at most
        counts, alone, asked = [0] * shards, [0] * shards, {}
        for r in found:
            counts[r.shard] += r.n
            alone[r.shard] += r.alone
            if r.to is not None:
                asked.setdefault((r.shard, r.to), {})[r.gain_class] = r.n
        if not asked and turn:
            break
        # As many as ask for the way back may go from one shard to another; what room a shard has beyond is given out in order.
        free, back = list(alone), [[0] * shards for _ in range(shards)]
        room = [max(0, q + int(q * SLACK) - c) for q, c in zip(quota, counts, strict=True)]
        shares: list[tuple[int, int, int, float]] = []
        for (one, other), classes in sorted(asked.items()):
            want = sum(classes.values())
            swaps = min(want, sum(asked.get((other, one), {}).values()))
            more = min(room[other], want - swaps)
            room[other] -= more
            give = min(free[other], want - swaps - more)
            free[other] -= give
            back[other][one] = give
            left = swaps + more + give
            for c in sorted(classes, reverse=True):  # the largest gains first; of the last class a share, by a hash
                shares.append((one, other, c, min(1.0, left / classes[c])))
                left = max(0, left - classes[c])
        allowed = F.broadcast(state.sparkSession.createDataFrame(shares, "shard int, to int, gain_class int, share double"))  # as many rows as were collected
        moved = joined.join(allowed, ["shard", "to", "gain_class"], "left")
        goes = F.when(F.pmod(F.xxhash64("h", F.lit(turn)), F.lit(1 << 30)) / (1 << 30) < F.col("share"), F.col("to"))
        # Of a shard's documents without links, about as many as asked for, by a hash between 0 and 1 that falls below a running share.
        ends = [[sum(b[: k + 1]) / max(1, n) for k in range(shards)] for b, n in zip(back, alone, strict=True)]
        drawn = F.pmod(F.xxhash64("h", F.lit(200 + turn)), F.lit(1 << 30)) / (1 << 30)
        own = F.element_at(F.array(*[F.array(*[F.lit(x) for x in e]) for e in ends]), F.col("shard") + 1)
        over = F.size(F.filter(own, lambda x: x <= drawn))
        makes_room = F.when((F.col("weight") == 0) & (over < shards), over)
        state = moved.select("node", "h", "weight", "hub", F.coalesce(goes, makes_room, "shard").cast("int").alias("shard"))
        freed(state.sparkSession)
    state = cut(state)
    return _settled(state, quota, shards)


def _settled(state: DataFrame, quota: list[int], shards: int) -> DataFrame:
    """Moves the surplus of full shards, least linked nodes first, into the room of the others, in runs."""
    counts = _counts(state, shards)
    if counts == quota:
        return state
    over = [max(0, c - q) for q, c in zip(quota, counts, strict=True)]
    room = [max(0, q - c) for q, c in zip(quota, counts, strict=True)]
    # Rank by the number of links (logarithmic classes), so that whoever leaves cuts few; within a class by hub, in slices that split a hot one.
    link_class = F.when(F.col("weight") <= 0, 0).otherwise(F.least(F.lit(62), F.floor(F.log2(F.col("weight").cast("double"))) + 1)).cast("int")
    of_hub = F.pmod(F.xxhash64("hub", F.lit(5)), F.lit(256))
    piece = F.when(F.col("weight") < SPLIT, of_hub).otherwise(F.floor(of_hub / 64) * 64 + F.pmod(F.xxhash64("h", F.lit(6)), F.lit(64)))
    ranked = rank(state, "shard", link_class * 256 + piece.cast("int"), [F.col("hub"), F.col("h"), F.col("node")], "place")
    before = [sum(over[:k]) for k in range(shards)]
    at = F.col("place") + F.element_at(_array(before), F.col("shard") + 1)  # a running number over all that leave
    ends, run = [], 0
    for r in room:
        run += r
        ends.append(run)
    to = F.lit(shards - 1)
    for k in reversed(range(shards)):
        to = F.when(at < ends[k], F.lit(k)).otherwise(to)
    leaves = F.col("place") < F.element_at(_array(over), F.col("shard") + 1)
    return ranked.withColumn("shard", F.when(leaves, to).otherwise(F.col("shard")).cast("int")).drop("place")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, size, text_crc32, shard and slot (gapless from 0 in its shard). Equal texts are linked."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), F.md5(text.cast("binary")).alias("same"))
    # A number for each row: ids may repeat or be null. It is fixed by the checkpoint, and only names the row.
    rows = cut(rows.withColumns({"h": F.xxhash64("doc_id", "same"), "node": F.monotonically_increasing_id()}))
    quota = max(1, rows.count() // shards)
    groups = cut(rows.groupBy("same").agg(F.count("*").alias("n")))  # then Spark can split the join on a hot text
    # A group that no shard has room for is several stars, whose centres start in different shards.
    piece = F.pmod(F.xxhash64("h", F.lit(4)), F.ceil(F.col("n") / quota)).alias("piece")
    linked = cut(rows.join(groups.where("n > 1"), "same").select("same", "node", "h", piece, (F.col("n") > quota).alias("split")))
    pieces = cut(linked.groupBy("same", "piece", "split").agg(F.min(F.struct("h", "node")).alias("first")).select("same", "piece", "split", F.col("first.node").alias("b")))
    leaves = cut(linked.join(pieces.drop("split"), ["same", "piece"]).where("node <> b").select(F.col("node").alias("a"), "b"))
    links = leaves.union(leaves.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weights = cut(links.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("weight")))
    seats = pieces.where("split").select(F.col("b").alias("node"), F.pmod(F.xxhash64("same") + F.col("piece"), F.lit(shards)).cast("int").alias("seat"))
    nodes = rows.join(weights, "node", "left").join(seats, "node", "left").select("node", "h", F.coalesce("weight", F.lit(0)).alias("weight"), F.xxhash64("same").alias("hub"), "seat")
    links = links.join(weights.select(F.col("node").alias("b"), F.col("weight").alias("bw")), "b")
    placed = propagate(cut(nodes), links, shards, rounds)
    final = rows.join(placed.select("node", "shard"), "node").select("doc_id", "size", "text_crc32", "shard", "h", "node")
    return rank(final, "shard", _sliced(F.col("h"), 9), [F.col("h"), F.col("node")], "slot").drop("h", "node")
