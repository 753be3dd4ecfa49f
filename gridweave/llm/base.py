"""What every operator of this subpackage shares: cutting lineage, picking columns."""

from __future__ import annotations

import ctypes
import functools
import gc
import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from . import words

#: Null document ids sort behind all others.
LAST_ID = (1 << 63) - 1

#: Spark's setting for the bytes of an Arrow batch, and what small_batches() asks for: one slice of sliced().
BATCH_BYTES, SMALL = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors and the driver see: spark.checkpoint.dir. Where that is unset, a temporary one on a single machine (tests), an error on a cluster."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="gridweave-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the cluster's shared checkpoint folder and forget its lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def freed(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete shuffles and checkpoints that nothing refers to any more; it looks when the driver's JVM collects garbage, which a mostly idle driver does too seldom. Python's own garbage may refer to them too."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def trim() -> None:
    """Gives memory that this worker no longer uses back to the machine, tables that are soon made anew among it; workers are used again, and what they keep adds up."""
    words.forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def small_batches(spark: SparkSession) -> None:
    """Texts go to the workers in batches of SMALL bytes, unless the session has a size of its own. By default a task's texts are one batch, which the executor holds twice while it grows, and the worker until its last slice is done."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, SMALL)


def sliced(batches: Iterator[pa.RecordBatch], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches with a column `text` in slices of about `limit` bytes of text; a longer text comes alone."""
    for b in batches:
        if "text" not in b.schema.names or not b.num_rows:
            yield b
            continue
        ends, lo = np.cumsum(pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function for mapInArrow that sees its texts slice by slice and trims its worker when it is done."""

    @functools.wraps(work)
    def run(batches):
        try:
            yield from work(sliced(batches))
        finally:
            trim()

    return run


def picked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text, so that columns of any other name can't clash."""
    ship(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
