"""Writers: text, Markdown, CSV, XLSX and DOCX, one file's bytes for each document or table.

Files are made where the document is, as a binary column, and save() writes them there too, into a folder that all machines share. Large results are better
kept as tables: write_cells() and DataFrame writers.
"""

from __future__ import annotations

import csv
import io
import uuid
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import TABLE
from ..functions.predicates import GENERIC_HEADER
from ..functions.rendering import preview, with_final_newline
from ..operators.assembly import put_together
from ..operators.markdown import block_array, cells
from ..shipping import ship

EMPTY = "No tables found in document."
_BOM = b"\xef\xbb\xbf"
_XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'


def output_path(output: str, default_name: str = "output.docx") -> Path:
    """A path with a document suffix is that file, any other a folder that gets default_name; folders are made."""
    path = Path(output).expanduser()
    if path.suffix.lower() not in (".txt", ".docx", ".xlsx"):
        path = path / default_name
    path.parent.mkdir(parents=True, exist_ok=True)
    return path.resolve()


def _clean(text: str | None) -> str:
    return "".join(c for c in text or "" if c in "\t\n\r" or ord(c) >= 32)


def _archive(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in parts.items():
            z.writestr(zipfile.ZipInfo(name), _XML + body)  # a fixed date: equal tables give equal bytes
    return out.getvalue()


def _relations(targets: list[tuple[str, str]]) -> str:
    kind = "http://schemas.openxmlformats.org/officeDocument/2006/relationships/"
    return '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{k}" Type="{kind}{t}" Target="{to}"/>' for k, (t, to) in enumerate(targets, 1)) + "</Relationships>"


def xlsx(tables: list[dict], prefix: str = "Table", placeholder_sheet: str = "No_Tables", reason: str | None = None) -> bytes:
    """A workbook of text cells, a sheet for each table; without tables one sheet says why."""
    grids = [(f"{prefix}_{k}"[:31], [t["header"], *t["rows"]]) for k, t in enumerate(tables, 1)] or [(placeholder_sheet, [["info"], [reason or EMPTY]])]
    main, office = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    sheet = lambda rows: f'<worksheet xmlns="{main}"><sheetData>' + "".join("<row>" + "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(_clean(c))}</t></is></c>' for c in r) + "</row>" for r in rows) + "</sheetData></worksheet>"
    parts = {
        "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(grids) + 1)) + "</Types>",
        "_rels/.rels": _relations([("officeDocument", "xl/workbook.xml")]),
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="rId{k}"/>' for k, (n, _) in enumerate(grids, 1)) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": _relations([("worksheet", f"worksheets/sheet{k}.xml") for k in range(1, len(grids) + 1)]),
    }
    return _archive(parts | {f"xl/worksheets/sheet{k}.xml": sheet(rows) for k, (_, rows) in enumerate(grids, 1)})


def docx(blocks: list[dict], empty: str = "No content extracted.") -> bytes:
    """A document: a paragraph for each line that isn't blank, tables with their blank cells, an empty paragraph behind each block."""
    import re

    generic = re.compile(GENERIC_HEADER.replace(r"\p{Nd}", r"\d").replace(r"\z", r"\Z"))

    def paragraph(text: str, bold: bool = False) -> str:
        return f'<w:p><w:r>{"<w:rPr><w:b/></w:rPr>" if bold else ""}<w:t xml:space="preserve">{escape(_clean(text))}</w:t></w:r></w:p>' if text else "<w:p/>"

    def grid(t: dict) -> str:
        named = not all(generic.match(h or "") for h in t["header"]) or not t["rows"]  # a header alone stays as a scaffold
        rows = [*([(t["header"], True)] if named else []), *((r, False) for r in t["rows"])]
        return "<w:tbl><w:tblPr><w:tblStyle w:val=\"TableGrid\"/></w:tblPr>" + "".join("<w:tr>" + "".join(f"<w:tc>{paragraph(c or '', bold)}</w:tc>" for c in r) + "</w:tr>" for r, bold in rows) + "</w:tbl>"

    body = []
    for b in blocks:
        if b["kind"] == "text":
            body += [paragraph(x.strip()) for x in (b["text"] or "").splitlines() if x.strip()]
        elif b["table"] and b["table"]["header"]:
            body.append(grid(b["table"]))
        body.append(paragraph(""))
    main = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    return _archive({
        "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>',
        "_rels/.rels": _relations([("officeDocument", "word/document.xml")]),
        "word/document.xml": f'<w:document xmlns:w="{main}"><w:body>{"".join(body) or paragraph(empty)}</w:body></w:document>',
    })


def csv_bytes(header: list[str], rows: list[list[str]]) -> bytes:
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([header, *rows])
    return _BOM + out.getvalue().encode()


def _made(df: DataFrame, column: str, make, name: Column) -> DataFrame:
    ship(df.sparkSession)

    def work(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("name"), pa.array([make(x or []) for x in b.column(column).to_pylist()], pa.binary())], ["doc_id", "name", "content"])

    return df.select("doc_id", name.alias("name"), column).mapInArrow(work, "doc_id long, name string, content binary")


def workbooks(docs: DataFrame, name: str = "output_tables.xlsx", prefix: str = "Table", placeholder_sheet: str = "No_Tables", reason: str | None = None) -> DataFrame:
    """(doc_id, name, content) from (doc_id, tables)."""
    return _made(docs, "tables", lambda t: xlsx(t, prefix, placeholder_sheet, reason), F.lit(name))


def word_documents(docs: DataFrame, name: str = "output.docx") -> DataFrame:
    """(doc_id, name, content) from (doc_id, parts)."""
    return _made(docs, "parts", docx, F.lit(name))


def csv_files(docs: DataFrame, stem: str = "output_tables") -> DataFrame:
    """One file for each table of (doc_id, tables), or one that says that there is none."""
    none = docs.where(F.size("tables") == 0).select("doc_id", F.lit(f"{stem}_empty.csv").alias("n"), F.array(F.struct(F.array(F.lit("info")).alias("header"), F.array(F.array(F.lit(EMPTY))).alias("rows"))).alias("t"))
    some = docs.select("doc_id", F.posexplode("tables").alias("k", "x")).select("doc_id", F.concat(F.lit(f"{stem}_table_"), (F.col("k") + 1).cast("string"), F.lit(".csv")).alias("n"), F.array("x").alias("t"))
    return _made(some.union(none), "t", lambda t: csv_bytes(t[0]["header"], t[0]["rows"]), F.col("n"))


def previews(docs: DataFrame, stem: str = "output_tables") -> DataFrame:
    return docs.select("doc_id", F.lit(f"{stem}_preview.md").alias("name"), F.encode(preview(F.col("tables")), "UTF-8").alias("content"))


def text_files(docs: DataFrame, column: str = "text", name: str = "output.txt") -> DataFrame:
    return docs.select("doc_id", F.lit(name).alias("name"), F.encode(with_final_newline(F.col(column)), "UTF-8").alias("content"))


def text_then_tables(docs: DataFrame, name: str = "output.docx") -> DataFrame:
    """(doc_id, name, content) from (doc_id, text, tables): a Word document with the text first and all tables behind it."""
    prose = F.array(F.struct(F.lit("text").alias("kind"), F.col("text").alias("text"), F.lit(None).cast(TABLE).alias("table")))
    grids = F.transform("tables", lambda t: F.struct(F.lit("table").alias("kind"), F.lit(None).cast("string").alias("text"), t.cast(TABLE).alias("table")))
    blank = F.trim(F.coalesce("text", F.lit(""))) == ""
    return word_documents(docs.select("doc_id", F.concat(F.when(~blank, prose).otherwise(F.slice(prose, 1, 0)), grids).alias("parts")), name)


def word_documents_of_markdown(docs: DataFrame, extracted: DataFrame, pairs: list[tuple[str, str]], name: str = "output.docx", cleanup: bool = True) -> tuple[DataFrame, DataFrame]:
    """(files, tables) from Markdown (doc_id, text) and extracted tables (doc_id, table_no, table): the document put together, and the tables it shows (doc_id, tables)."""
    parts = put_together(docs.select("doc_id", block_array(F.col("text")).alias("b")), extracted, pairs if cleanup else [])
    return word_documents(parts, name), parts.select("doc_id", F.transform(F.filter("parts", lambda b: b["kind"] == "table"), lambda b: b["table"]).alias("tables"))


def markdown_files(docs: DataFrame, column: str = "markdown", name: str = "output_markdown.md") -> DataFrame:
    """The Markdown itself, unchanged."""
    return docs.select("doc_id", F.lit(name).alias("name"), F.encode(F.coalesce(column, F.lit("")), "UTF-8").alias("content"))


def table_exports(docs: DataFrame, workbook: bool = True, csv_: bool = True, markdown: bool = True) -> DataFrame:
    """All exports of (doc_id, tables) that are asked for, as one frame of files."""
    made = [f(docs) for f, wanted in ((workbooks, workbook), (csv_files, csv_), (previews, markdown)) if wanted]
    out = made[0] if made else workbooks(docs).where("false")
    for other in made[1:]:
        out = out.unionByName(other)
    return out


def export_tables(docs: DataFrame, folder: str, **kinds: bool) -> list[Path]:
    """table_exports(), saved; the paths that were written."""
    return save(table_exports(docs, **kinds), folder)


def save(files: DataFrame, folder: str) -> list[Path]:
    """Writes files (doc_id, name, content) below folder/<doc_id>/, each by the task that made it; the folder must be one that all machines share. The driver gets the paths only."""
    ship(files.sparkSession)

    def write(batches):
        for b in batches:
            paths = []
            for doc_id, name, content in zip(*(b.column(k).to_pylist() for k in ("doc_id", "name", "content")), strict=True):
                path = Path(folder) / str(doc_id) / name
                path.parent.mkdir(parents=True, exist_ok=True)
                part = path.with_name(f".{path.name}.{uuid.uuid4().hex}")  # a task that runs twice leaves one whole file
                part.write_bytes(content or b"")
                part.replace(path)
                paths.append(str(path))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], ["path"])

    return [Path(r.path) for r in files.select("doc_id", "name", "content").mapInArrow(write, "path string").collect()]


def write_cells(tables: DataFrame, path: str) -> None:
    """All cells of (doc_id, table_no, table) as Parquet, for any number of documents."""
    cells(tables, "doc_id", "table_no").write.parquet(path)
