"""The queries of this subpackage: each applies an operator, with production parameters, to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, lines, lm, minhash, packing, quality, secretscan, shards, sql, substrings, toxicity
from .base import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secretscan.scan(docs, secretscan.trained(secretscan.findings(docs)))
    text = "array_join(transform({0}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"
    counts = [F.expr(f"cast(size(filter(spans, x -> x.kind = '{k}')) as long)").alias(f"n_{k}") for k in secretscan.KINDS[:3]]
    base = F.expr(text.format("filter(spans, x -> x.kind <> 'net')"))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), F.expr(text.format("spans")).alias("spans"))


def op4_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard_documents(table(spark, sf_dir, "documents"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash", "first")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    net = toxicity.trained(docs, labels.where(~held_out))
    scored = toxicity.score(docs, net)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "threshold", "flagged")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the lines removed (numbers from 0; null: none) and the text's digest without them."""
    out = lines.drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), lost_col="removed")
    return out.select("doc_id", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), F.array_join("removed", ",").alias("removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = (op1_quality_rules, op2_substring_dedup, op3_secret_scan, op4_bm25_packing, op5_label_propagation_shards, op6_minhash_near_dedup, op7_toxicity, op8_line_dedup, op9_lm_score, op10_decontaminate)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": sql.OP1, "op2_substring_dedup": sql.OP2, "op6_minhash_near_dedup": sql.OP6, "op10_decontaminate": sql.OP10}
