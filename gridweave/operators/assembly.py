"""Documents put together from their own blocks and the tables that a backend has extracted.

Blocks and tables meet by a join on the document; what is scored pair by pair is an expression; the choice among candidates, which depends on the blocks before,
is a fold over each document (folds.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.base import let, no_tables
from ..functions.rendering import plain_grid
from ..functions.similarity import similarity
from ..functions.text import WHITE, markdown_to_plain
from .folds import BLOCK, fold_document


def composed(parts: Column) -> Column:
    """The document's text: prose and padded grids, blank lines between, a final line end."""
    texts = F.filter(F.transform(parts, lambda b: F.when(b["kind"] == "text", b["text"]).otherwise(plain_grid(b["table"]))), lambda x: x != "")
    return let(F.regexp_replace(F.array_join(texts, "\n\n"), rf"{WHITE}+\z", ""), lambda x: F.when(x == "", F.lit("")).otherwise(F.concat(x, F.lit("\n"))))


def documents(blocks: DataFrame, extracted: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(doc_id, parts, marked, found) from blocks (doc_id, block_no, kind, text, table) and extracted tables (doc_id, table_no, table).

    parts: the document put together; marked: how many of its own blocks are tables; found: the extracted tables in order.
    """
    return put_together(blocks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("block_no", "kind", "text", "table"))).alias("b")), extracted, pairs)


def put_together(own: DataFrame, extracted: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """documents() of blocks that are arrays already: (doc_id, b). Only extracted tables are shuffled and, to meet them, these rows."""
    b = own.select("doc_id", "b")
    e = extracted.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("table_no", "table"))).alias("e"))
    both = b.join(e, "doc_id", "full_outer")
    own = F.coalesce(F.transform("b", lambda x: F.struct(x["kind"].alias("kind"), markdown_to_plain(x["text"]).alias("text"), x["table"].alias("table"))), F.array().cast(f"array<{BLOCK}>"))
    both = both.select("doc_id", own.alias("b"), F.coalesce(F.transform("e", lambda x: x["table"]), no_tables()).alias("found"))
    # The condition always holds. It names both inputs again, so that they are not inlined into the fold: the optimizer loses a Python expression that it moves over a join with an empty side.
    parts = F.when(F.size("b") + F.size("found") >= 0, fold_document(F.col("b"), F.col("found"), pairs))
    return both.select("doc_id", parts.alias("parts"), F.size(F.filter("b", lambda x: x["kind"] == "table")).alias("marked"), "found")


def matches(blocks: DataFrame, extracted: DataFrame) -> DataFrame:
    """Every pair of a document's table block and an extracted table, scored; rank 1 is the best for the block."""
    # Tables can be far larger than the files that Spark judges a broadcast by, so both sides are shuffled by the document, as the ranking needs it anyway.
    own = blocks.where("kind = 'table'").select("doc_id", "block_no", F.col("table").alias("m")).hint("merge")
    pairs = own.join(extracted.select("doc_id", "table_no", F.col("table").alias("e")), "doc_id")
    scored = pairs.select("doc_id", "block_no", "table_no", similarity(F.col("m"), F.col("e")).alias("score"))
    best = Window.partitionBy("doc_id", "block_no").orderBy(F.desc("score"), "table_no")
    return scored.withColumn("rank", F.row_number().over(best))
