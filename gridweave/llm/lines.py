"""Fuzzy line dedup by MinHash: of lines that are alike, only the first in the corpus stays.

A line is compared by its normal form: A-Z lower-cased, white space runs as one space, none at the ends. Its set is the distinct runs of SHINGLE
characters (code points) of its normal form; a normal form of fewer than WHOLE characters is one element as a whole, so short lines are alike if
they are equal. Blank lines stay. Steps:

1. every document's lines get a 64-bit hash of their normal form, which finds lines, and those that matter a 128-bit one, which tells them apart, and, from a signature of
   56 minima over character shingles, 14 band keys of four each; two lines with a similarity of 0.8 share none with a chance of 0.0006;
2. keys travel in blocks, one for each range of keys, of which a task sorts one at a time: keys that two different lines share become lists, lines that come twice are
   noted. Nothing else goes on (a range above RANGE_BYTES does as it is; what it has too much finds no partner later);
3. a second scan fetches the occurrences of those lines, and the texts and signatures of the ones in lists; bitmaps of fixed size, filled with hashes of their ids, let few others pass,
   and joins drop those;
4. within lists, signatures that agree in 32 of 56 places link lines, by their 64 bits, into groups; within groups, sets are compared, and lines with
   100 * |A & B| >= 80 * |A | B| are linked (components.spanning(): walks, no lists of pairs);
5. distributed union-find gives components; the occurrence with the smallest (document id, hash of the text, line number) stays, all others go;
6. only documents that lose a line are moved to meet what they lose, again behind a bitmap; the others pass by.

Odd input: null texts have no lines and stay null; empty texts stay empty; a null id comes last; rows that share an id, or have none, but differ in their texts are documents of
their own, in the order of the texts' xxhash64; rows that repeat an id and a text lose the same lines (none of them holds a line before the other); extra columns are kept as they are by drop_lines().
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .base import LAST_ID, cut, freed, lean, partitions, picked, ship, trim, unused
from .components import breadth_first, connected, spanning
from .minhash import by_sets
from .words import mix, pieces, utf8

SHINGLE, WHOLE, PERCENT = 6, 20, 80
BANDS, ROWS, MATCHES = 14, 4, 32
BITMAP_BITS = 1 << 26
#: Ranges of keys for each task, and what is sorted at once.
RANGES, RANGE_BYTES = 4, 128 << 20
#: What one task walks of a list, in signatures, and of a group, in lines or as many times 64 bytes of text.
LIST_LIMIT, GROUP_LIMIT = 20_000, 4_000

_A = mix(np.arange(1, 1 + BANDS * ROWS, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)


def normal_lines(text: bytes) -> list[bytes]:
    """The normal form of each line."""
    return [b" ".join(line.split()) for line in text.lower().split(b"\n")]  # bytes.lower() changes A-Z only


def lines_of(column) -> list[list[bytes]]:
    """normal_lines() of each text (null: empty); most texts have only single spaces and need nothing but to be cut."""
    data, at = utf8(column)
    line, gap = data == 0x0A, data <= 0x20
    odd = (data < 0x20) & ~line
    odd[1:] |= gap[1:] & gap[:-1] & ~(line[1:] & line[:-1])
    some = np.diff(at) > 0
    for edge in (at[:-1][some], at[1:][some] - 1):
        odd[edge] |= data[edge] == 0x20
    other = np.zeros(len(at) - 1, bool)
    other[np.searchsorted(at, np.flatnonzero(odd), "right") - 1] = True
    return [normal_lines(t) if x else t.lower().split(b"\n") for t, x in zip(_texts(column), other.tolist(), strict=True)]


def fuzzy(own: bytes) -> bool:
    return len(own) >= 4 * WHOLE or len(own) >= WHOLE and (own.isascii() or len(own.decode()) >= WHOLE)


def node_of(own: bytes) -> bytes:
    return hashlib.blake2b(own, digest_size=16).digest()


def _runs(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value of the SHINGLE characters from each character on; where lines begin (and the last ends)."""
    joined = b"".join(lines)
    code, begin = np.frombuffer(joined, np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in lines]))).astype(np.int64)
    if not joined.isascii():
        begin = np.concatenate(([0], np.cumsum(np.add.reduceat((code & 0xC0) != 0x80, begin[:-1], dtype=np.int64))))  # no line is empty
        code = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32)
    half, n = SHINGLE // 2, max(0, len(code) - SHINGLE + 1)
    code = code.astype(np.uint64)
    three = code[: max(0, len(code) - half + 1)].copy()  # a character has 21 bits
    for j in range(1, half):
        three |= code[j : j + len(three)] << np.uint64(21 * j)
    value = three[:n] * np.uint64(0x9E3779B97F4A7C15)
    value += three[half : half + n]
    return value, begin


def shingle_sets(lines: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each line's set."""
    out = [np.frombuffer(node_of(x)[:8], np.uint64) for x in lines]
    at = [k for k, x in enumerate(lines) if fuzzy(x)]
    value, begin = _runs([lines[k] for k in at])
    value = mix(value)
    for k, s, e in zip(at, begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        out[k] = np.unique(value[s : e - SHINGLE + 1])
    return out


def signed(lines: list[bytes]) -> np.ndarray:
    """A signature for each line (fuzzy ones only): minima of multiplicative hash functions over the hashed shingles; repeated shingles don't change them."""
    out = np.empty((len(lines), BANDS * ROWS), np.uint32)
    for lo, hi in pieces(np.concatenate(([0], np.cumsum([len(x) for x in lines]))).astype(np.int64), 1 << 16):
        value, begin = _runs(lines[lo:hi])
        inside = np.ones(len(value), bool)
        inside[begin[1:-1, None] - np.arange(1, SHINGLE)] = False  # runs over the end of a line
        h = (mix(value[inside]) >> np.uint64(32)).astype(np.uint32)
        h |= np.uint32(1)  # no multiple of it is 0
        at = begin[:-1] - (SHINGLE - 1) * np.arange(hi - lo)
        x, least = np.empty_like(h), np.empty((BANDS * ROWS, hi - lo), np.uint32)
        for c in range(BANDS * ROWS):
            np.multiply(h, _A[c], out=x)
            np.minimum.reduceat(x, at, out=least[c])
        out[lo:hi] = least.T
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A key for each band; it is odd in the first one, and even in the others."""
    keys = np.zeros((len(signature), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(signature), b + 1, np.uint64)
        for r in range(ROWS):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + signature[:, b * ROWS + r])
        keys[:, b] = (h & ~np.uint64(1)) | np.uint64(b == 0)
    return keys.view(np.int64)


def _texts(column) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def shorts_of(lines: list[bytes]) -> np.ndarray:
    """64 bits for each line."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines)).view(np.int64)


def _band_rows(ranges: int):
    """(range, block): each line's rows (key, short), once for each batch; a line's first row twice if the batch has the line twice. A short line has one key."""

    def work(batches):
        for b in batches:
            count: Counter[bytes] = Counter()
            for own in lines_of(b.column("text")):
                count.update(own)
            count.pop(b"", None)
            rows, lines = [], [x for x in count if fuzzy(x)]
            for lo in range(0, len(lines), 4096):
                part = lines[lo : lo + 4096]
                keys, short = band_keys(signed(part)), shorts_of(part)
                more = np.array([count[x] > 1 for x in part])
                rows.append(np.stack([np.concatenate((keys.ravel(), keys[more, 0])), np.concatenate((np.repeat(short, BANDS), short[more]))], 1))
            rest = [x for x, n in count.items() if not fuzzy(x) for _ in range(min(n, 2))]
            short = shorts_of(rest)
            rows.append(np.stack([(mix(short.view(np.uint64)) | np.uint64(1)).view(np.int64), short], 1))
            rows = np.concatenate(rows)
            part = ((rows[:, 0].view(np.uint64) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(part.astype(np.uint16) if ranges <= 1 << 16 else part, kind="stable")
            part, raw = part[order], rows[order].tobytes()
            begin = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.zeros(0, np.int64)
            ends = np.append(begin[1:], len(part)) if len(part) else begin
            yield pa.RecordBatch.from_arrays([pa.array(part[begin]), pa.array([raw[16 * x : 16 * y] for x, y in zip(begin.tolist(), ends.tolist(), strict=True)], pa.binary())], ["range", "block"])

    return work


def _wanted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (key, short) whose keys have several shorts, each once; shorts of rows with odd keys that come twice."""
    order = np.argsort(rows[:, 0])
    key = rows[order, 0]
    same = np.zeros(len(rows) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    rows = rows[order[same[1:] | same[:-1]]]  # most keys come once
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(1)
    begin = np.flatnonzero(new)
    many = np.diff(np.append(begin, len(rows))) > 1
    rows = rows[begin]
    alike = np.zeros(len(rows) + 1, bool)
    alike[1:-1] = rows[1:, 0] == rows[:-1, 0]
    return rows[alike[1:] | alike[:-1]], rows[many & (rows[:, 0] & 1 == 1), 1]


def _shared(batches):
    """(key, short) of lists, (null, short) of lines that come twice, from blocks in the order of their ranges."""

    def out(lists: list[np.ndarray], twice: list[np.ndarray]) -> pa.RecordBatch:
        rows, short = np.concatenate([np.zeros((0, 2), np.int64), *lists]), np.concatenate([np.zeros(0, np.int64), *twice])
        key = np.concatenate((rows[:, 0], np.zeros(len(short), np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(key, mask=np.arange(len(key)) >= len(rows)), pa.array(np.concatenate((rows[:, 1], short)))], ["key", "short"])

    last, held, size = None, [], 0
    for b in batches:
        lists, twice = [], []
        for number, block in zip(b.column("range").to_pylist(), b.column("block").to_pylist(), strict=True):
            if number != last and held:
                for into, found in zip((lists, twice), _wanted(np.frombuffer(b"".join(held), np.int64).reshape(-1, 2)), strict=True):
                    into.append(found)
                held, size = [], 0
            if number != last:
                last, size = number, 0
            size += len(block)
            if size <= RANGE_BYTES:
                held.append(block)
            else:  # too many rows for one sort: all of them go on
                lists.append(np.frombuffer(b"".join([*held, block]), np.int64).reshape(-1, 2))
                held = []
        yield out(lists, twice)
    if held:
        rows, short = _wanted(np.frombuffer(b"".join(held), np.int64).reshape(-1, 2))
        yield out([rows], [short])


def bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the hashes in the only column; a few megabytes, whatever the number of rows."""
    bits = hashes.select(F.pmod(F.col(hashes.columns[0]), F.lit(BITMAP_BITS)).alias("b"))
    words = bits.selectExpr("cast(b div 64 as int) as w", "shiftleft(1L, cast(b % 64 as int)) as m").groupBy("w").agg(F.bit_or("m").alias("m"))
    out = np.zeros(BITMAP_BITS // 64, np.uint64)
    t = words.toArrow()  # at most BITMAP_BITS / 64 rows
    out[t.column("w").to_numpy()] = t.column("m").to_numpy().view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes % BITMAP_BITS
    return (bits[at // 64] >> (at % 64).astype(np.uint64) & np.uint64(1)).astype(bool)


def _occurrences(docs: DataFrame, wanted, listed) -> DataFrame:
    """(short, node, doc_id, text_hash, line, text, signature) of each line that may be wanted (bitmaps, broadcast); the last two only where it may be in a list, once for each batch."""

    def find(batches):
        for b in batches:
            ids, hashes = b.column("doc_id").fill_null(LAST_ID).to_numpy(), b.column("text_hash").to_numpy()
            lines, count = [], []
            for own in lines_of(b.column("text")):
                lines += own
                count.append(len(own))
            short = shorts_of(lines)
            at = np.flatnonzero(in_bitmap(wanted.value, short) & np.fromiter(map(bool, lines), bool, len(lines)))
            count = np.array(count, np.int64)
            row = np.repeat(np.arange(len(count)), count)
            number = (np.arange(len(lines)) - np.repeat(np.cumsum(count) - count, count)).astype(np.int32)[at]
            row, short, lines = row[at], short[at], [lines[i] for i in at.tolist()]
            node = {x: node_of(x) for x in dict.fromkeys(lines)}
            new: set[bytes] = set()
            shown = in_bitmap(listed.value, short) & np.array([x not in new and not new.add(x) and fuzzy(x) for x in lines], bool)
            some = [lines[i] for i in np.flatnonzero(shown).tolist()]
            text, signature = np.full(len(lines), None, object), np.full(len(lines), None, object)
            text[shown], signature[shown] = some, [x.tobytes() for x in signed(some).astype(np.uint8)]  # the lowest byte of each minimum
            yield pa.RecordBatch.from_arrays([pa.array(short), pa.array([node[x] for x in lines], pa.binary()), pa.array(ids[row]), pa.array(hashes[row]), pa.array(number), pa.array(text, pa.binary()), pa.array(signature, pa.binary())], _SEEN)

    return docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(lean(find), "short long, node binary, doc_id long, text_hash long, line int, text binary, signature binary")


_SEEN = ["short", "node", "doc_id", "text_hash", "line", "text", "signature"]


def by_signature(payloads: list[bytes]):
    """Links of lines whose signatures agree in MATCHES places."""
    s = np.frombuffer(b"".join(payloads), np.uint8).reshape(len(payloads), -1)
    return breadth_first(len(s), lambda i, others: (s[others] == s[i]).sum(1) >= MATCHES)


def _alike(left: list[bytes], right: list[bytes]) -> np.ndarray:
    s, t = (np.frombuffer(b"".join(x), np.uint8).reshape(len(x), -1) for x in (left, right))
    return (s == t).sum(1) >= MATCHES


by_signature.two = _alike  # most lists


def by_text(payloads: list[bytes]):
    """Links of lines by their full sets."""
    return by_sets([s.tobytes() for s in shingle_sets(payloads)], PERCENT)


def removed_lines(docs: DataFrame, list_limit: int = LIST_LIMIT, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(doc_id, text_hash, lines): the numbers of the lines to remove, for documents (doc_id, text) that lose any; null ids as LAST_ID, texts as their xxhash64."""
    send = docs.sparkSession.sparkContext.broadcast
    tasks = partitions(docs.sparkSession)
    keys = docs.select("text").mapInArrow(lean(_band_rows(tasks * RANGES)), "range long, block binary")
    postings = cut(keys.repartition(tasks, "range").sortWithinPartitions("range").mapInArrow(lean(_shared), "key long, short long"))
    freed(docs.sparkSession)
    lists = postings.where("key is not null")
    wanted, listed = send(bitmap(postings.select("short"))), send(bitmap(lists.select("short")))
    seen = cut(_occurrences(docs, wanted, listed))
    wanted.destroy(), listed.destroy()
    freed(docs.sparkSession)
    shown = seen.where("text is not null")
    # Distinct rows need no order, unlike first ones of each node, and what they are dealt by serves the join.
    signatures = shown.select("short", F.col("signature").alias("payload")).repartition("short").distinct()
    rows = lists.join(signatures, "short").select("key", F.col("short").alias("node"), "payload")  # groups are only candidates: 64 bits will do, and are cheaper to link
    groups = connected(spanning(rows, lists.groupBy("key").agg(F.count("*").alias("n")), by_signature, list_limit))
    groups = groups.select(F.col("node").alias("short"), F.col("component").alias("key"))
    members = cut(shown.select("short", "node", F.col("text").alias("payload")).join(groups, "short").select("short", "key", "node", "payload").distinct().drop("short"))
    sizes = members.groupBy("key").agg(F.greatest(F.count("*"), F.sum(F.octet_length("payload")) / 64).cast("long").alias("n")).where("n > 1")
    components = connected(spanning(members, sizes, by_text, group_limit))
    at = cut(seen.select("node", F.struct("doc_id", "text_hash", "line").alias("at")).join(components, "node", "left").select(F.coalesce("component", "node").alias("label"), "at"))
    first = cut(at.groupBy("label").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").select("label", "first"))
    freed(docs.sparkSession)
    lost = at.join(first, "label").where("at <> first").select("at.*")
    return lost.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("line")).alias("lines"))  # at most a document's lines


def _hit(shared):
    @F.arrow_udf("boolean")
    def hit(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for hashes in parts:
                yield pa.array(in_bitmap(shared.value, hashes.to_numpy(zero_copy_only=False)))
        finally:
            trim()

    return hit


@F.arrow_udf(StringType())
def _without(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    try:
        for text, lines in parts:
            out = []
            for t, numbers in zip(text.to_pylist(), lines.to_pylist(), strict=True):
                gone = set(numbers or ())
                out.append(t if t is None or not gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone))
            yield pa.array(out, pa.string())
    finally:
        text = lines = out = None
        trim()


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lost_col: str = "removed_lines", **limits: int) -> DataFrame:
    """The documents with all columns, their text without the lines to remove, and lost_col, or that name with underscores behind it if it is taken: those lines' numbers (null: none)."""
    ship(docs.sparkSession)
    key, text, lost_col = unused(docs, "lost_id"), unused(docs, "lost_text"), unused(docs, lost_col)
    lost = cut(removed_lines(picked(docs, id_col, text_col), **limits).select(F.col("doc_id").alias(key), F.col("text_hash").alias(text), F.col("lines").alias(lost_col)))
    hit = _hit(docs.sparkSession.sparkContext.broadcast(bitmap(lost.select(F.xxhash64(key, text)))))
    own_id, own_hash = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)), F.xxhash64(F.col(f"`{text_col}`").cast("string"))
    row: Column = F.xxhash64(own_id, own_hash)
    joined = docs.where(hit(row)).join(lost, (own_id == F.col(key)) & (own_hash == F.col(text)), "left")
    cleaned = [_without(F.col(f"`{text_col}`").cast("string"), F.col(lost_col)).alias(text_col) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return docs.where(~hit(row)).withColumn(lost_col, F.lit(None).cast("array<int>")).unionByName(joined.select(*cleaned, lost_col))
