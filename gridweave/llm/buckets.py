"""Documents in buckets of a few megabytes, and compact messages between buckets and hash shards.

Operators that compare word sequences over the whole corpus would shuffle a row for each word. Here a bucket (neighbouring rows of the input) sends each
shard of the hash space one message: its distinct hashes, sorted and Elias-Fano coded. A shard answers each message in the message's order. A hot word or passage is thus
sent once by each bucket, not once by each document, and no group is larger than a bucket or a shard. Buckets and shards keep their size when the
corpus grows; a message gets smaller then, at worst down to a single entry, which is what a plain shuffle would send.

A bucket is filled by bytes, whatever the ids in it: one repeated or null id, or a range of long texts, makes no larger one (a single longer text does). Buckets
are made once and kept in the shared checkpoint folder, so that what is lost later is made again from them; a step that needs them beside their answers moves them, compressed, once. Within a bucket ids ascend; null ids come last; rows with equal ids are ordered by their text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import LAST_ID, cut, partitions
from .words import utf8

#: Bytes of text in a bucket, about.
BUCKET_BYTES = 6 << 20
#: Shards for each bucket: a shard holds about this many buckets' worth of distinct hashes.
BUCKETS_A_SHARD = 3
#: Tasks of a shuffle beyond what the session asks for; more buckets share a task.
MOST_TASKS = 50_000

PACKED = "bucket long, blob binary"
_squeeze = zstandard.ZstdCompressor(level=1)
_expand = zstandard.ZstdDecompressor()


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays, one after another, each compressed on its own behind its length."""
    parts = [_squeeze.compress(np.ascontiguousarray(a).tobytes()) for a in arrays]
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def expand(blob: bytes, *kinds: type) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        n = int.from_bytes(blob[at : at + 4], "little")
        out.append(np.frombuffer(_expand.decompress(blob[at + 4 : at + 4 + n]), kind))
        at += 4 + n
    return out


class Plan:
    """How many shards and tasks there are: a few numbers, whatever the size of the corpus."""

    def __init__(self, docs: DataFrame, bucket_bytes: int | None = None):
        self.bytes = bucket_bytes or BUCKET_BYTES
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(1, -(-int(total) // self.bytes))
        self.shards = max(1, min(buckets // BUCKETS_A_SHARD, 1 << 31))
        most = max(partitions(docs.sparkSession), min(buckets // 8, MOST_TASKS))
        self.tasks, self.shard_tasks = min(buckets, most), min(self.shards, max(most, MOST_TASKS))

    def shard_ranges(self, hashes: np.ndarray) -> list[tuple[int, int, int]]:
        """(shard, begin, end) of the shards that the sorted hashes fall into; no others are looked at."""
        if not len(hashes):
            return []
        shard = (hashes >> np.uint64(32)) * np.uint64(self.shards) >> np.uint64(32)
        begin = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
        return list(zip(shard[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(hashes)], strict=True))


def pack_texts(ids: np.ndarray, texts: list[bytes]) -> bytes:
    lengths = np.array([len(t) for t in texts], np.int64)
    return squeeze(ids.astype(np.int64), lengths, np.frombuffer(b"".join(texts), np.uint8))


def unpack_texts(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids ascending, bytes of all texts, offsets."""
    parts = [expand(b, np.int64, np.int64, np.uint8) for b in blobs]
    ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    texts: list[bytes] = []
    for _, lengths, data in parts:
        ends = np.cumsum(lengths)
        raw = data.tobytes()
        texts += [raw[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
    order = np.argsort(ids, kind="stable")
    if len(ids) > 1 and (np.diff(ids[order]) == 0).any():
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], texts[i])), np.int64)
    texts = [texts[i] for i in order.tolist()]
    return ids[order], np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)


def bucketed(docs: DataFrame, plan: Plan) -> DataFrame:
    """(bucket, blob): a row for each bucket, kept."""
    most = plan.bytes

    def pack(batches):
        bucket = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        texts: list[bytes] = []
        size = 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([pack_texts(np.array(ids, np.int64), texts)], pa.binary())], ["bucket", "blob"])

        for b in batches:
            own = np.array(b.column("doc_id").fill_null(LAST_ID), np.int64).tolist()
            data, offsets = utf8(b.column("text"))
            raw, at = data.tobytes(), offsets.tolist()
            for k, i in enumerate(own):
                text = raw[at[k] : at[k + 1]]
                if ids and size + len(text) > most:
                    yield out()
                    bucket, ids, texts, size = bucket + 1, [], [], 0
                ids.append(i)
                texts.append(text)
                size += len(text)
        if ids:
            yield out()

    return cut(docs.mapInArrow(pack, PACKED))


def id_column(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == LAST_ID)
