"""Pages of documents: text and Markdown by plug-ins with a fallback, rasters by plug-ins, ruled tables from lines and words.

A converter, renderer or engine is a plain function that a deployment brings; it runs in Arrow batches, where a failure of one document or page is that document's or
page's alone. What follows from its results is relations and expressions.
"""

from __future__ import annotations

import gc
import logging
import sys
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.geometry import DPI
from ..operators.prose import page_text
from ..shipping import ship
from .backends import Backend, ExtractionError

#: Resolutions of rasters for recognition and for models, points of room around a box, and of height, that text needs.
RECOGNITION_DPI, MODEL_DPI, MARGIN, LEAST_HEIGHT = 200, 300, 8.0, 4.0
#: How far lines may stand apart, in points, and still be one.
SNAP = 3.0

_log = logging.getLogger(__name__)


def release_memory() -> None:
    """Gives back what a model holds, on the device too where there is one."""
    gc.collect()
    torch = sys.modules.get("torch")  # only where a plug-in has loaded it
    if torch is not None and torch.cuda.is_available():
        torch.cuda.empty_cache()


def has_device() -> bool:
    """Can models run on a CUDA device here?"""
    torch = sys.modules.get("torch")
    return bool(torch is not None and torch.cuda.is_available())


def markdown(files: DataFrame, convert: Callable[[str, bytes], str], fallback: DataFrame | None = None, skip: bool = False) -> DataFrame:
    """(doc_id, text, converted) of files (doc_id, path, content).

    convert(path, content) gives Markdown; an error, an empty result or a path that doesn't end in .pdf is a failure of that file. A failed file takes its text from the fallback
    (doc_id, text), as all files do with `skip`; without one it is left out.
    """
    if skip and fallback is None:
        raise ExtractionError("without a document model there must be a fallback")
    ids = files.select(F.col("doc_id").cast("long"))
    if skip:
        return ids.join(fallback.select("doc_id", "text"), "doc_id", "left").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit(False).alias("converted"))
    ship(files.sparkSession)

    def one(path: str, content: bytes) -> str | None:
        try:
            if not path.lower().endswith(".pdf"):
                raise ExtractionError(f"not a PDF: {path}")
            return convert(path, content) or None
        except Exception as e:  # whatever a plug-in raises is this file's failure
            _log.warning("no Markdown for %s: %s", path, str(e)[-1500:])
            return None

    def work(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([one(p, c) for p, c in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True)], pa.string())], ["doc_id", "text"])
        release_memory()

    found = files.select(F.col("doc_id").cast("long"), "path", "content").mapInArrow(work, "doc_id long, text string").withColumn("converted", F.col("text").isNotNull())
    if fallback is None:
        return found.where("converted")
    spare = fallback.select("doc_id", F.col("text").alias("spare"))
    return found.join(spare, "doc_id", "left").select("doc_id", F.coalesce("text", "spare", F.lit("")).alias("text"), "converted")


def page_parts(words: DataFrame, boxes: DataFrame, sizes: DataFrame) -> DataFrame:
    """(doc_id, page_no, boxed, full, above, below) for prose.page_text().

    words: lines of the text layer (doc_id, page_no, y0, y1, line_no, text); boxes: of tables (doc_id, page_no, y0, y1); sizes: (doc_id, page_no, height), in points. Text above
    or below a box counts if there is more room than MARGIN and it is LEAST_HEIGHT high.
    """
    box = boxes.groupBy("doc_id", "page_no").agg(F.min("y0").alias("top"), F.max("y1").alias("bottom"))
    pages = sizes.select("doc_id", "page_no", "height").join(box, ["doc_id", "page_no"], "left")
    own = pages.join(words.select("doc_id", "page_no", "y0", "y1", "line_no", "text"), ["doc_id", "page_no"], "left")
    text = lambda where: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(where & F.col("text").isNotNull(), F.struct("line_no", "text")))), lambda x: x["text"]), "\n")
    above = (F.col("top") > MARGIN) & (F.col("top") >= LEAST_HEIGHT)
    below = (F.col("height") - F.col("bottom") > MARGIN) & (F.col("height") - F.col("bottom") >= LEAST_HEIGHT)
    return own.groupBy("doc_id", "page_no").agg(
        F.max(F.col("top").isNotNull()).alias("boxed"), text(F.lit(True)).alias("full"),
        F.when(F.max(above), text(F.col("y1") <= F.col("top"))).alias("above"), F.when(F.max(below), text(F.col("y0") >= F.col("bottom"))).alias("below"),
    )


def text_layer(words: DataFrame, boxes: DataFrame, sizes: DataFrame) -> DataFrame:
    """(doc_id, text): the fallback where no document model runs."""
    return page_text(page_parts(words, boxes, sizes))


def rendered(pages: DataFrame, render: Callable[..., bytes], dpi: int = DPI, gray: bool = False, boxes: DataFrame | None = None) -> DataFrame:
    """(doc_id, page_no, image) of pages (doc_id, page_no, content).

    render(content, page_no, dpi=, gray=, box=) gives a raster's bytes. With boxes (doc_id, page_no, x0, y0, x1, y1) a page is cropped to its own, and rendered whole where it has
    none or the crop fails. Prune pages before, by plans.jobs.flagged_pages().
    """
    ship(pages.sparkSession)
    corners = ["x0", "y0", "x1", "y1"]
    if boxes is None:
        own = pages.select("doc_id", "page_no", "content", F.lit(None).cast("array<double>").alias("box"))
    else:
        own = pages.select("doc_id", "page_no", "content").join(boxes.select("doc_id", "page_no", F.array(*[F.col(c).cast("double") for c in corners]).alias("box")), ["doc_id", "page_no"], "left").select("doc_id", "page_no", "content", "box")

    def one(content: bytes, page: int, box: list[float] | None) -> bytes:
        if box is not None:
            try:
                return render(content, page, dpi=dpi, gray=gray, box=tuple(box))
            except Exception as e:
                _log.warning("page %s is rendered whole: %s", page, e)
        return render(content, page, dpi=dpi, gray=gray, box=None)

    def work(batches):
        for b in batches:
            images = [one(c, p, x) for c, p, x in zip(*(b.column(k).to_pylist() for k in ("content", "page_no", "box")), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("page_no"), pa.array(images, pa.binary())], ["doc_id", "page_no", "image"])

    return own.select(F.col("doc_id").cast("long"), F.col("page_no").cast("int"), "content", "box").mapInArrow(work, "doc_id long, page_no int, image binary")


def analysed(pages: DataFrame, engine: Callable[[bytes], str], column: str = "page_result") -> DataFrame:
    """Pages (doc_id, page_no, image) with what the engine says of each, as JSON text; a page on which it fails has an empty list."""
    ship(pages.sparkSession)

    def one(image: bytes) -> str:
        try:
            return engine(image) or "[]"
        except Exception as e:
            _log.warning("page analysis failed: %s", e)
            return "[]"

    def work(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("page_no"), pa.array([one(x) for x in b.column("image").to_pylist()], pa.string())], ["doc_id", "page_no", column])

    return pages.select(F.col("doc_id").cast("long"), F.col("page_no").cast("int"), "image").mapInArrow(work, f"doc_id long, page_no int, {column} string")


def _positions(found: DataFrame, at: str, name: str) -> DataFrame:
    """(doc_id, page_no, grid, name, number): places at which lines stand, those closer than SNAP as one."""
    order = Window.partitionBy("doc_id", "page_no", "grid").orderBy(at)
    new = F.coalesce((F.col(at) - F.lag(at).over(order) > SNAP).cast("int"), F.lit(0))
    numbered = found.withColumn("new", new).withColumn("number", F.sum("new").over(order))
    return numbered.groupBy("doc_id", "page_no", "grid", "number").agg(F.avg(at).alias(name))


def _cells(positions: DataFrame, name: str, low: str, high: str) -> DataFrame:
    order = Window.partitionBy("doc_id", "page_no", "grid").orderBy("number")
    return positions.select("doc_id", "page_no", "grid", F.col("number").alias(f"{name}_no"), F.col(name).alias(low), F.lead(name).over(order).alias(high)).where(F.col(high).isNotNull())


def ruled_tables(lines: DataFrame, words: DataFrame) -> DataFrame:
    """Raw grids (doc_id, page_no, index_on_page, rows) for operators.grids.grid_tables().

    lines: drawn ones (doc_id, page_no, x0, y0, x1, y1), words: (doc_id, page_no, x0, y0, x1, y1, text), in points from the top left. Vertical lines whose heights overlap rule one
    table; its columns stand between them, its rows between the horizontal lines there. A word belongs to the cell that holds its middle; a cell's words
    are joined line by line; grids without any text or without two lines each way are left out.
    """
    is_upright = F.abs(F.col("x1") - F.col("x0")) <= F.abs(F.col("y1") - F.col("y0"))
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    upright = lines.where(is_upright).select("doc_id", "page_no", ((F.col("x0") + F.col("x1")) / 2).alias("x"), low.alias("top"), high.alias("bottom"))
    order = Window.partitionBy("doc_id", "page_no").orderBy("top", "bottom", "x")
    reach = F.max("bottom").over(order.rowsBetween(Window.unboundedPreceding, -1))
    upright = upright.withColumn("new", F.coalesce((F.col("top") > reach + SNAP).cast("int"), F.lit(0))).withColumn("grid", F.sum("new").over(order))
    extent = upright.groupBy("doc_id", "page_no", "grid").agg(F.min("top").alias("top"), F.max("bottom").alias("bottom"))
    level = lines.where(~is_upright).select("doc_id", "page_no", ((F.col("y0") + F.col("y1")) / 2).alias("y")).join(extent, ["doc_id", "page_no"]).where((F.col("y") >= F.col("top") - SNAP) & (F.col("y") <= F.col("bottom") + SNAP))
    columns, rows = _cells(_positions(upright, "x", "x"), "x", "left", "right"), _cells(_positions(level, "y", "y"), "y", "upper", "lower")
    cells = rows.join(columns, ["doc_id", "page_no", "grid"])
    place = words.select("doc_id", "page_no", ((F.col("x0") + F.col("x1")) / 2).alias("wx"), ((F.col("y0") + F.col("y1")) / 2).alias("wy"), "text")
    inside = (F.col("wx") >= F.col("left")) & (F.col("wx") < F.col("right")) & (F.col("wy") >= F.col("upper")) & (F.col("wy") < F.col("lower"))
    grid = ["doc_id", "page_no", "grid", "y_no", "x_no"]
    held = cells.join(place, ["doc_id", "page_no"]).where(inside).groupBy(*grid, F.round(F.col("wy") / SNAP).alias("line")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("wx", "text"))), lambda w: w["text"]), " ").alias("text"))
    held = held.groupBy(*grid).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda w: w["text"]), "\n").alias("text"))
    filled = cells.select(*grid).join(held, grid, "left").groupBy(*grid[:-1]).agg(F.transform(F.array_sort(F.collect_list(F.struct("x_no", "text"))), lambda c: c["text"]).alias("row"))
    found = filled.groupBy("doc_id", "page_no", "grid").agg(F.transform(F.array_sort(F.collect_list(F.struct("y_no", "row"))), lambda r: r["row"]).alias("rows")).where(F.exists("rows", lambda r: F.exists(r, lambda c: c.isNotNull())))
    on_page = Window.partitionBy("doc_id", "page_no").orderBy("grid")
    return found.select("doc_id", F.col("page_no").cast("int"), (F.row_number().over(on_page) - 1).cast("int").alias("index_on_page"), "rows")


def with_crop_pass(backend: Callable[[DataFrame], Backend], whole: DataFrame, cropped: DataFrame) -> DataFrame:
    """Tables of a model that sees whole pages first, and only then, for documents without any, the pages cropped to their boxes: (doc_id, backend, table_no, table).

    backend(pages) binds the model to rendered pages (doc_id, page_no, image).
    """
    from ..plans.jobs import cascade

    first, second = backend(whole), backend(cropped)
    other = Backend(f"{second.name}_cropped", lambda left: second.extract(cropped.join(left.select("doc_id").distinct(), "doc_id", "left_semi")))
    return cascade(whole, [first, other])


def project_root(start: str | Path | None = None) -> Path:
    """The nearest folder above (or this package's) that holds a project file; the package's parent where there is none."""
    own = Path(start or __file__).resolve()
    for folder in [own, *own.parents]:
        if any((folder / name).exists() for name in ("pyproject.toml", "setup.py", ".git")):
            return folder
    return Path(__file__).resolve().parents[2]
