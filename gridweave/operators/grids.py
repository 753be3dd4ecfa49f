"""Raw grids (ragged rows, nulls for cells without text) as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import fitted, let, rest, table, widest
from ..functions.names import generic_names, grid_names
from ..functions.text import raw_cell


def grid_table(rows: Column, header_row: bool = True) -> Column:
    """The first row names the columns, or names are made up; rows are padded or cut to that width."""

    def build(rows: Column) -> Column:
        names = grid_names(F.get(rows, F.lit(0))) if header_row else generic_names(widest(rows))
        body = rest(rows, F.lit(1)) if header_row else rows
        return let(names, lambda h: table(h, F.transform(body, lambda r: F.transform(fitted(r, F.size(h)), raw_cell))))

    return F.when(F.size(rows) > 0, let(rows, build))


def with_provenance(t: Column, page_no: Column, index_on_page: Column) -> Column:
    """Columns page (from 1) and table_index in front."""
    own = F.array((page_no + 1).cast("string"), index_on_page.cast("string"))
    return table(F.concat(F.array(F.lit("page"), F.lit("table_index")), t["header"]), F.transform(t["rows"], lambda r: F.concat(own, r)))


def grid_tables(grids: DataFrame, header_row: bool = True, provenance: bool = False) -> DataFrame:
    """(doc_id, page_no, index_on_page, table) from raw grids (doc_id, page_no, index_on_page, rows); empty grids are left out."""
    found = grids.where(F.size("rows") > 0).withColumn("table", grid_table(F.col("rows"), header_row))
    if provenance:
        found = found.withColumn("table", with_provenance(F.col("table"), F.col("page_no"), F.col("index_on_page")))
    return found.select("doc_id", "page_no", "index_on_page", "table")
