"""Extraction backends as plug-ins.

A backend turns pages into tables: a function from pages (doc_id, page_no, ...) to (doc_id, page_no, index_on_page, table). Recognition models run in such functions,
in Arrow batches, one load for each worker. Nothing here imports one; a backend that can't run on a cluster is simply not in the list given to cascade().
"""

from __future__ import annotations

import functools
import os
import sys
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import TABLE
from ..functions.predicates import is_empty
from ..operators.grids import grid_tables
from ..operators.responses import as_arrow, page_htmls, response_tables, tables_of_html
from ..shipping import ship

#: What a model is asked, in short; a deployment passes its own prompt.
PROMPT = "Return every table of the page image, in reading order, as one HTML table element each: one tr for each printed row, one td for each cell (blank ones too), colspan and rowspan as printed, codes and numbers verbatim. Nothing else. If HTML is impossible, return JSON: {\"headers\": [...], \"rows\": [[...]]}."


class ExtractionError(RuntimeError):
    """A source can't give what it is asked for."""


class DocumentModelError(ExtractionError):
    """A document model gives no Markdown."""


class RecognitionError(ExtractionError):
    """Structure recognition gives no tables."""


class ModelError(ExtractionError):
    """A vision model gives no tables."""


@dataclass(frozen=True)
class ModelOptions:
    """Options of a vision model backend (defaults are fixed values)."""

    model: str = "2B"
    max_new_tokens: int = 8192
    temperature: float = 0.1
    do_sample: bool = False
    dpi: int = 300
    crop_to_table: bool = False
    prompt: str = PROMPT


@dataclass(frozen=True)
class Backend:
    name: str
    extract: Callable[[DataFrame], DataFrame]


@functools.cache
def loaded(factory: Callable, *args):
    """One instance for each worker process, whatever the number of tasks."""
    return factory(*args)


def numbered(tables: DataFrame) -> DataFrame:
    """One row for each table that isn't empty, from (doc_id, page_no, tables)."""
    rows = tables.select("doc_id", "page_no", F.posexplode("tables").alias("index_on_page", "table"))
    return rows.where(~is_empty(F.col("table")))


def grid_backend(header_row: bool = True) -> Backend:
    """Drawn grids: pages carry `rows` (array<array<string>>) and index_on_page."""
    return Backend("grid", lambda pages: grid_tables(pages, header_row).where(~is_empty(F.col("table"))))


def html_backend(name: str = "paddle", column: str = "page_result") -> Backend:
    """Structure recognition: pages carry a result as JSON text."""

    def extract(pages: DataFrame) -> DataFrame:
        htmls = pages.select("doc_id", "page_no", F.posexplode(page_htmls(F.col(column))).alias("index_on_page", "html"))
        return htmls.select("doc_id", "page_no", "index_on_page", F.get(tables_of_html(F.col("html")), F.lit(0)).alias("table")).where(~is_empty(F.col("table")))

    return Backend(name, extract)


def model_backend(infer: Callable[[list[dict]], list[str]], name: str = "vlm", columns: tuple[str, ...] = ("image",)) -> Backend:
    """A model that answers each page with text; infer gets the pages of a batch as records."""

    def extract(pages: DataFrame) -> DataFrame:
        ship(pages.sparkSession)

        def work(batches):
            for b in batches:
                answers = infer(b.select(list(columns)).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("page_no"), as_arrow([response_tables(a) for a in answers])], ["doc_id", "page_no", "tables"])

        return numbered(pages.select("doc_id", F.col("page_no").cast("int"), *columns).mapInArrow(work, f"doc_id long, page_no int, tables array<{TABLE}>"))

    return Backend(name, extract)


def first_table(tables: Column) -> Column:
    return F.get(tables, F.lit(0))


def skips_model(skip: bool | None = None, force: bool | None = None, env: dict | None = None) -> bool:
    """Is the document model skipped? Arguments count before the environment, force before skip; by default it is."""
    env = os.environ if env is None else env
    told = lambda name: {"1": True, "true": True, "yes": True, "0": False, "false": False, "no": False}.get(env.get(name, "").strip().lower())
    if force:
        return False
    if skip is not None:
        return skip
    return False if told("FORCE_MARKER") else told("SKIP_MARKER") is not False


def isolates_processes(platform: str | None = None) -> bool:
    return (platform or sys.platform).startswith("win")


