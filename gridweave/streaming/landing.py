"""A landing folder as a stream: each micro-batch of new Markdown files goes through the same plan as a batch job.

Documents are independent of each other, so no state is kept between batches; the checkpoint remembers which files are done, and a batch that is
run again overwrites its own folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.markdown import blocks


def arriving(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """(doc_id, path, text) of files as they arrive."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.schema(schema).format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.xxhash64("path").alias("doc_id"), "path", F.decode("content", "UTF-8").alias("text"))


def write_blocks(stream: DataFrame, output: str, checkpoint: str, plan: Callable[[DataFrame], DataFrame] = blocks, once: bool = True) -> StreamingQuery:
    """Runs the plan over each micro-batch and writes its rows to output/batch=<number>."""

    def each(batch: DataFrame, number: int) -> None:
        plan(batch).write.mode("overwrite").parquet(f"{output}/batch={number}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    return (writer.trigger(availableNow=True) if once else writer).start()
