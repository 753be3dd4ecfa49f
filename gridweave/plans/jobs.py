"""Jobs over any number of documents.

Each job is one lazy plan; the blocks of a document are computed once and serve assembly, text and counts alike. The cascade asks each backend
only for documents that those before it gave no table for.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.base import TABLE, no_tables
from ..functions.cleanup import corrected_table
from ..operators.assembly import composed, put_together
from ..operators.folds import BLOCK, fold_tables, stitch_responses
from ..operators.markdown import block_array, parsed
from ..sources.backends import Backend
from .once import once

HAS_TABLES, TEXT_ONLY = "HAS_TABLES", "TEXT_ONLY"
NONE, MARKER, FAILED = "none", "marker", "failed"


def classify(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, route) from documents and pages with tables (doc_id, page_no)."""
    found = pages.select("doc_id").distinct().withColumn("hit", F.lit(True))
    return docs.select("doc_id").join(found, "doc_id", "left").select("doc_id", F.when(F.col("hit"), HAS_TABLES).otherwise(TEXT_ONLY).alias("route"))


def flagged_pages(pages: DataFrame, flagged: DataFrame) -> DataFrame:
    """Only the pages worth an expensive look."""
    return pages.join(flagged.select("doc_id", "page_no").distinct(), ["doc_id", "page_no"], "left_semi")


def cascade(pages: DataFrame, backends: list[Backend]) -> DataFrame:
    """(doc_id, backend, table_no, table): each document's tables from the first backend that finds any.

    A backend's rows are written once (once()) before the next one is asked, so a model sees a page once.
    """
    done: DataFrame | None = None
    left = pages
    for b in backends:
        rows = once(b.extract(left).select("doc_id", F.lit(b.name).alias("backend"), "page_no", "index_on_page", "table"))
        done = rows if done is None else done.unionByName(rows)
        left = left.join(rows.select("doc_id").distinct(), "doc_id", "left_anti")
    if done is None:
        raise ValueError("no backend given")
    ordered = done.groupBy("doc_id", "backend").agg(F.array_sort(F.collect_list(F.struct("page_no", "index_on_page", "table"))).alias("t"))
    return ordered.select("doc_id", "backend", F.posexplode("t").alias("table_no", "t")).select("doc_id", "backend", "table_no", "t.table")


def stitched(tables: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Corrected tables (doc_id, table_no, table), those that go on over pages joined."""
    own = tables.select("doc_id", "table_no", corrected_table(F.col("table"), pairs).alias("table")).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("table_no", "table"))).alias("t"))
    return own.select("doc_id", F.posexplode(fold_tables(F.transform("t", lambda x: x["table"]), stitch_responses)).alias("table_no", "table"))


def classic(docs: DataFrame) -> DataFrame:
    """(doc_id, tables, text, table_count, markdown): parse only, without corrections, repair or matching. Nothing is shuffled."""
    return parsed(docs, F.col("text").alias("markdown")).select("doc_id", "tables", "text", "markdown", F.size("tables").alias("table_count"))


@dataclass(frozen=True)
class Options:
    skip_tables: bool = False


def unified(docs: DataFrame, flagged: DataFrame, tables: DataFrame, pairs: list[tuple[str, str]], options: Options = Options()) -> DataFrame:
    """One row for each document: parts, tables, text, table_count, pages_with_tables, backend, used_marker_fallback.

    docs: (doc_id, text), each doc_id once; flagged: pages with tables (doc_id, page_no); tables: what the cascade gave (doc_id, backend, table_no, table), which
    counts only for documents with flagged pages.
    """
    pages = flagged.groupBy("doc_id").agg(F.array_sort(F.collect_set("page_no")).alias("pages_with_tables"))
    found = tables.join(pages.select("doc_id"), "doc_id", "left_semi")
    found = found.limit(0) if options.skip_tables else found
    by = found.groupBy("doc_id").agg(F.min_by("backend", "table_no").alias("given_by"))
    row = docs.select("doc_id").join(put_together(docs.select("doc_id", block_array(F.col("text")).alias("b")), found, pairs), "doc_id", "left").join(pages, "doc_id", "left").join(by, "doc_id", "left")
    row = row.withColumns({"parts": F.coalesce("parts", F.array().cast(f"array<{BLOCK}>")), "found": F.coalesce("found", no_tables()), "pages_with_tables": F.coalesce("pages_with_tables", F.array().cast("array<int>"))})
    kept = F.transform(F.filter("parts", lambda b: b["kind"] == "table"), lambda b: b["table"])
    # Tables that assembly has dropped altogether are reported all the same.
    final = F.when(F.size(kept) > 0, kept).otherwise(F.col("found"))
    backend = F.when(F.size("pages_with_tables") == 0, NONE).when(F.lit(options.skip_tables), MARKER).otherwise(F.coalesce("given_by", F.lit(FAILED)))
    row = row.withColumns({"tables": final.cast(f"array<{TABLE}>"), "backend": backend})
    count = F.when(F.size("tables") > 0, F.size("tables")).otherwise(F.coalesce("marked", F.lit(0))).cast("int")
    return row.select("doc_id", "parts", "tables", composed(F.col("parts")).alias("text"), count.alias("table_count"), "pages_with_tables", "backend", (F.col("backend") == MARKER).alias("used_marker_fallback"))


def exit_code(results: DataFrame) -> int:
    """2 if some document's table pages gave no table, else 0."""
    return 2 if results.where(F.col("backend") == FAILED).limit(1).count() else 0


def routed(docs: DataFrame, flagged: DataFrame, tables: Callable[[DataFrame], DataFrame], pairs: list[tuple[str, str]], options: Options = Options()) -> DataFrame:
    """unified() for documents with table pages; the others skip extraction. tables(docs) extracts, and is asked for the former only."""
    hot = classify(docs, flagged).where(F.col("route") == HAS_TABLES).select("doc_id")
    return unified(docs, flagged, tables(docs.join(hot, "doc_id", "left_semi")), pairs, options)
