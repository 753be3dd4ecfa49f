"""Tables as text: padded pipe grids and Markdown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import at, fitted, indexes, let, lets
from .predicates import headers_are_generic, is_empty
from .text import cell_text


def matrix(t: Column) -> Column:
    """Clean cells, with the header in front unless it is generic."""
    header = F.transform(t["header"], cell_text)
    rows = F.transform(t["rows"], lambda r: F.transform(fitted(r, F.size(t["header"])), cell_text))
    return F.when(headers_are_generic(header), rows).otherwise(F.concat(F.array(header), rows))


def plain_grid(t: Column) -> Column:
    """`| a | b |` lines with padded cells; '' for an empty table."""

    def widths(m: Column, n: Column) -> Column:
        return F.transform(indexes(n), lambda c: F.greatest(F.lit(1), F.array_max(F.transform(m, lambda r: F.length(at(r, c))))))

    def lines(m: Column, w: Column) -> Column:
        cells = lambda r: F.zip_with(r, w, lambda x, k: F.concat(x, F.repeat(F.lit(" "), k - F.length(x))))
        return F.array_join(F.transform(m, lambda r: F.concat(F.lit("| "), F.array_join(cells(r), " | "), F.lit(" |"))), "\n")

    return F.when(is_empty(t), F.lit("")).otherwise(lets(matrix(t), lambda m: widths(m, F.size(t["header"])), lines))


def markdown_table(t: Column) -> Column:
    """A pipe table of Markdown; pipes in cells are escaped, line feeds are spaces."""

    def line(cells: Column) -> Column:
        return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

    body = F.transform(t["rows"], lambda r: line(F.transform(r, lambda c: F.replace(F.replace(c, F.lit("\n"), F.lit(" ")), F.lit("|"), F.lit("\\|")))))
    dashes = F.transform(t["header"], lambda _: F.lit("---"))
    return F.when(F.size(t["header"]) == 0, F.lit("_empty table_")).otherwise(F.array_join(F.concat(F.array(line(t["header"]), line(dashes)), body), "\n"))


def preview(tables: Column, placeholder: str = "No tables found in document.") -> Column:
    """All tables of a document as one Markdown text."""
    parts = F.transform(tables, lambda t, i: F.concat(F.lit("\n## Table "), (i + 1).cast("string"), F.lit("\n\n"), markdown_table(t), F.lit("\n")))
    return F.when(F.size(tables) == 0, F.lit(f"# Tables preview\n\n_{placeholder}_\n")).otherwise(F.concat(F.lit("# Tables preview\n"), F.array_join(parts, "")))


def with_final_newline(text: Column) -> Column:
    return let(text, lambda x: F.when(x.endswith("\n"), x).otherwise(F.concat(x, F.lit("\n"))))
