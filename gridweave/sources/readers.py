"""Readers: document files, raw grids, page rasters, workbooks, dictionaries.

PDF renderers and recognition models are not part of this library. They plug in as functions from an Arrow batch of files or pages to rows of the fixed
schemas below (see backends.py); what is read here needs nothing beyond Spark and the standard library.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.base import TABLE
from ..functions.predicates import is_empty, is_placeholder
from ..operators.responses import _ARROW
from ..shipping import ship

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def documents(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(doc_id, path, content) of files; ids are hashes of the paths."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select(F.xxhash64("path").alias("doc_id"), "path", "content")


def texts(spark: SparkSession, path: str, pattern: str = "*.md") -> DataFrame:
    """(doc_id, path, text) of text files, whole."""
    return documents(spark, path, pattern).select("doc_id", "path", F.decode("content", "UTF-8").alias("text"))


def grids(spark: SparkSession, path: str) -> DataFrame:
    """Raw grids from JSON lines (doc_id, page_no, index_on_page, rows)."""
    return spark.read.schema("doc_id long, page_no int, index_on_page int, rows array<array<string>>").json(path)


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheets(content: bytes) -> Iterator[tuple[str, list[list[str]]]]:
    """(name, rows of strings) of a workbook's sheets, in order; nothing is read as a number or date."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter(f"{{{_NS['m']}}}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        for k, sheet in enumerate(book.find("m:sheets", _NS), 1):
            rows: list[list[str]] = []
            for row in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{k}.xml")).iter(f"{{{_NS['m']}}}row"):
                cells: dict[int, str] = {}
                for j, c in enumerate(row.findall("m:c", _NS)):
                    v = c.find("m:v", _NS)
                    text = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t")) if c.get("t") == "inlineStr" else (v.text or "") if v is not None else ""
                    cells[_column(c.get("r")) if c.get("r") else j] = shared[int(text)] if c.get("t") == "s" and text else text
                rows.append([cells.get(j, "") for j in range(max(cells, default=-1) + 1)])
            yield sheet.get("name"), rows


def workbook_tables(files: DataFrame) -> DataFrame:
    """(doc_id, tables) of workbooks (doc_id, content): each sheet's first row is the header; placeholder sheets and empty ones are left out."""
    ship(files.sparkSession)

    def read(batches):
        for b in batches:
            out = []
            for content in b.column("content").to_pylist():
                own = [rows for _, rows in sheets(content) if rows]
                out.append([{"header": rows[0], "rows": [(r + [""] * len(rows[0]))[: len(rows[0])] for r in rows[1:]]} for rows in own])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, _ARROW)], ["doc_id", "tables"])

    found = files.select("doc_id", "content").mapInArrow(read, f"doc_id long, tables array<{TABLE}>")
    return found.select("doc_id", F.filter("tables", lambda t: ~is_empty(t) & ~is_placeholder(t)).alias("tables"))
