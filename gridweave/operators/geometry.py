"""Ruled lines in page images: ink profiles, bands, table pages and boxes.

A page image becomes a long relation ink(doc_id, page_no, axis, idx, frac), axis `row` or `col`; everything from there on is windows and sums. Profiles
of rasters come from numpy in Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship

#: Image resolution, grey below which a pixel is dark, share of dark pixels of a line, bands of a table, pixels that a band may miss.
DPI, DARK, LINE_SHARE, LEAST_BANDS, GAP, PADDING = 150, 180, 0.2, 5, 3, 0.02


def ink(pages: DataFrame, dark: int = DARK) -> DataFrame:
    """ink from grey rasters (doc_id, page_no, width, height, pixels binary of width * height bytes)."""
    ship(pages.sparkSession)

    def profile(batches):
        for b in batches:
            out: list[tuple] = []
            for d, p, w, h, data in zip(*(b.column(k).to_pylist() for k in ("doc_id", "page_no", "width", "height", "pixels")), strict=True):
                is_dark = np.frombuffer(data, np.uint8).reshape(h, w) < dark
                for axis, k in (("row", 1), ("col", 0)):
                    out += [(d, p, axis, i, x) for i, x in enumerate((is_dark.sum(k) / (w if k else h)).tolist())]
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["doc_id", "page_no", "axis", "idx", "frac"])

    return pages.select("doc_id", F.col("page_no").cast("int"), "width", "height", "pixels").mapInArrow(profile, "doc_id long, page_no int, axis string, idx int, frac double")


def bands(profile: DataFrame, share: float = LINE_SHARE, gap: int = GAP) -> DataFrame:
    """(doc_id, page_no, axis, band, start, end): runs of lines with more ink than the share, over gaps of up to `gap`."""
    order = Window.partitionBy("doc_id", "page_no", "axis").orderBy("idx")
    dark = profile.where(F.col("frac") > share).withColumn("new", F.coalesce((F.col("idx") - F.lag("idx").over(order) > gap).cast("int"), F.lit(0)))
    numbered = dark.withColumn("band", F.sum("new").over(order))
    return numbered.groupBy("doc_id", "page_no", "axis", "band").agg(F.min("idx").alias("start"), F.max("idx").alias("end"))


def band_counts(found: DataFrame) -> DataFrame:
    """(doc_id, page_no, rows, cols) and the first and last line of either axis."""
    own = lambda axis, x: F.when(F.col("axis") == axis, F.col(x))
    return found.groupBy("doc_id", "page_no").agg(F.count(own("row", "band")).alias("rows"), F.count(own("col", "band")).alias("cols"), F.min(own("row", "start")).alias("y0"), F.max(own("row", "end")).alias("y1"), F.min(own("col", "start")).alias("x0"), F.max(own("col", "end")).alias("x1"))


def scanned_table_pages(profile: DataFrame, least: int = LEAST_BANDS) -> DataFrame:
    """(doc_id, page_no) of pages with enough bands on both axes."""
    return band_counts(bands(profile)).where((F.col("rows") >= least) & (F.col("cols") >= least)).select("doc_id", "page_no")


def table_boxes(profile: DataFrame, sizes: DataFrame, dpi: int = DPI, least: int = LEAST_BANDS, padding: float = PADDING) -> DataFrame:
    """(doc_id, page_no, x0, y0, x1, y1) in points, from the first to the last band, padded; sizes: (doc_id, page_no, width, height) in pixels."""
    found = band_counts(bands(profile)).where((F.col("rows") >= least) & (F.col("cols") >= least)).join(sizes, ["doc_id", "page_no"])
    pad = lambda a, b: ((F.col(b) - F.col(a)) * padding).cast("int") + 5
    scale = 72.0 / dpi
    low = lambda a, b: F.greatest(F.lit(0), F.col(a) - pad(a, b)) * scale
    high = lambda a, b, most: F.least(F.col(most), F.col(b) + pad(a, b)) * scale
    return found.select("doc_id", "page_no", low("x0", "x1").alias("x0"), low("y0", "y1").alias("y0"), high("x0", "x1", "width").alias("x1"), high("y0", "y1", "height").alias("y1"))


def table_pages(vector: DataFrame, visual: DataFrame, use_visual: bool = True) -> DataFrame:
    """(doc_id, page_no): pages (doc_id, page_no) with drawn tables; for documents without any, those that look like scanned ones."""
    own = vector.select("doc_id", "page_no").distinct()
    if not use_visual:
        return own
    return own.unionByName(visual.select("doc_id", "page_no").distinct().join(own.select("doc_id").distinct(), "doc_id", "left_anti"))
