"""A corpus pipeline: toxicity, line dedup, near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last return the columns of documents. run() writes each stage's
result as Parquet into the cluster's shared checkpoint folder and reads it again as the next one's docs. Stages set the session's Arrow batches to
a few megabytes, as workers and executors live through all of them; run() takes that back.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm import decontaminate, lines, minhash, packing, toxicity
from gridweave.llm.base import BATCH_BYTES, LAST_ID, freed, shared_folder, small_batches, table, unused

#: Words of a shingle in the near-duplicate stage, and the similarity in percent.
SHINGLE, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches their language's calibrated threshold go."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's text without lines that are alike one before; a document of which no word is left goes. n_chars follows the text."""
    small_batches(spark)
    out = lines.drop_lines(docs)
    lost = F.col(out.columns[-1])
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(lost.isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    gone = lost.isNotNull() & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return out.where(~gone).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id (of equal or null ones, the smallest hash of the text) stays, and of rows that repeat an id and a text one."""
    small_batches(spark)
    key, text = unused(docs, "row_id"), unused(docs, "row_text")
    lost = minhash.near_duplicates(docs, SHINGLE, PERCENT).where("not first").select(F.coalesce("doc_id", F.lit(LAST_ID)).alias(key), F.col("text_hash").alias(text)).distinct()
    rows = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), text: F.xxhash64(F.col("text").cast("string"))})
    return rows.join(lost, [key, text], "left_anti").dropDuplicates([key, text]).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_repeated_lines), ("near-dedup", drop_near_duplicates), ("decontamination", drop_contaminated), ("packing", pack)]

#: The classifier and the packing order can't be put as SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    own = spark.conf.get(BATCH_BYTES, None)
    try:
        for k, (_, stage) in enumerate(STAGES):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                _delete(spark, f"{folder}/{k - 1}")  # the stage before has done its work
            freed(spark)
    finally:
        if own is None:
            spark.conf.unset(BATCH_BYTES)
    return docs


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
