"""Markdown documents as ordered blocks of text and tables.

A document is one row, so its lines are segmented where they are, without a shuffle: each line is a letter (row, start of a table, other), the letters
are one string, and a regular expression finds the runs. A table begins where a pipe row meets a separator and goes on while rows have pipes. What
can't be read as a table with rows goes back to the text behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import TABLE, at, fitted, indexes, leading, let, lets, rest, table, widest
from ..functions.names import parser_names
from ..functions.predicates import is_empty, is_headerless_row, is_mostly_empty, is_noise_row, is_separator, is_subheader_row, is_table_row, is_table_start
from ..functions.text import WHITE, header_cell, split_lines, split_row


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line)"""
    return docs.select("doc_id", F.posexplode(split_lines(F.coalesce("text", F.lit("")))).alias("line_no", "line"))


def _generic(n: Column) -> Column:
    return F.transform(indexes(n), lambda i: F.when(i == 0, F.lit("col")).otherwise(F.concat(F.lit("col_"), i.cast("string"))))


def _merged(rows: Column, n: Column) -> Column:
    """One name for each column: the rows' cells, joined."""
    return F.transform(indexes(n), lambda c: F.array_join(F.filter(F.transform(rows, lambda r: header_cell(at(r, c))), lambda x: x != ""), " "))


def table_of(block: Column) -> Column:
    """The table that the lines of a pipe block make; null if it has no header."""

    def read(block: Column, cut: Column, rows: Column, n: Column) -> Column:
        # Rows in front of the first separator are header rows; without any separator all are.
        before = F.when(cut == 0, F.size(rows)).otherwise(cut - 1)
        pre, post = F.slice(rows, F.lit(1), before), rest(rows, before)
        headerless = (F.size(pre) > 0) & F.coalesce(is_headerless_row(F.get(pre, F.lit(0))), F.lit(False))
        return lets(F.struct(headerless.alias("h"), F.when(headerless, F.array(_generic(n))).otherwise(pre).alias("pre"), F.when(headerless, F.concat(F.slice(pre, 1, 1), post)).otherwise(post).alias("post")), lambda s: headed(s, n))

    def headed(s: Column, n: Column) -> Column:
        absorb = lambda r: let(fitted(r, n), lambda p: is_mostly_empty(p) | is_subheader_row(p))
        more = F.when(s["h"], F.lit(0)).otherwise(leading(s["post"], absorb))
        return let(more, lambda k: built(s, n, F.concat(s["pre"], F.slice(s["post"], F.lit(1), k)), rest(s["post"], k)))

    def built(s: Column, n: Column, header_rows: Column, data: Column) -> Column:
        names = F.transform(_merged(header_rows, n), lambda x, i: F.when(s["h"] | (x != ""), x).when(i == 0, F.lit("col")).otherwise(F.concat(F.lit("col_"), i.cast("string"))))
        body = F.filter(F.transform(data, lambda r: fitted(r, n)), lambda r: ~is_noise_row(r))
        return F.when((n > 0) & (F.size(header_rows) > 0), table(let(names, parser_names), body))

    return lets(block, lambda b: F.array_position(F.transform(b, is_separator), True), lambda b, _: F.transform(F.filter(b, lambda x: ~is_separator(x)), split_row), lambda b, cut, rows: lets(widest(rows), lambda n: read(b, cut, rows, n)))


def segments(found: Column) -> Column:
    """array<struct<inside, lines>>: runs of lines within and between tables, from all lines of a document."""

    def letter(line: Column, i: Column) -> Column:
        start = is_table_start(line, F.get(found, i - 1), F.get(found, i + 1))
        return F.when(~is_table_row(line), F.lit(".")).when(start, F.lit("s")).otherwise(F.lit("r"))

    def cut(runs: Column) -> Column:
        sizes = F.transform(runs, lambda r: F.length(r))
        return let(sizes, lambda n: F.transform(runs, lambda r, k: F.struct(r.startswith("s").alias("inside"), F.slice(found, F.aggregate(F.slice(n, F.lit(1), k), F.lit(1), lambda x, y: x + y), F.length(r)).alias("lines"))))

    # A row directly in front of a start is no part of the table.
    return let(F.array_join(F.transform(found, letter), ""), lambda letters: cut(F.regexp_extract_all(letters, F.lit("s[rs]*|[.r]+"), F.lit(0))))


def block_array(text: Column) -> Column:
    """array<struct<kind, text, table>> in reading order."""

    def read(parts: Column) -> Column:
        tables = F.transform(parts, lambda p: F.when(p["inside"], table_of(p["lines"])))
        return let(F.transform(tables, lambda t: F.when(~is_empty(t), t)), lambda own: F.filter(F.transform(parts, lambda p, i: block(parts, own, p, i)), lambda b: b["kind"].isNotNull()))

    def block(parts: Column, own: Column, p: Column, i: Column) -> Column:
        # A table that failed becomes text together with the text behind it.
        failed = lambda k: F.coalesce(F.get(parts, k)["inside"] & F.get(own, k).isNull(), F.lit(False))
        behind = F.when(failed(i), F.coalesce(F.get(parts, i + 1)["lines"], F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))
        prose = F.regexp_replace(F.array_join(F.concat(p["lines"], behind), "\n"), rf"{WHITE}+\z", "")
        return let(prose, lambda x: F.struct(F.when(F.get(own, i).isNotNull(), F.lit("table")).when(~failed(i - 1) & (x != ""), F.lit("text")).alias("kind"), F.when(F.get(own, i).isNull(), x).alias("text"), F.get(own, i).alias("table")))

    return let(split_lines(F.coalesce(text, F.lit(""))), lambda found: let(segments(found), read))


def blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, block_no, kind, text, table) in reading order."""
    return docs.select("doc_id", F.posexplode(block_array(F.col("text"))).alias("block_no", "b")).select("doc_id", "block_no", "b.kind", "b.text", F.col("b.table").cast(TABLE).alias("table"))


def cells(tables: DataFrame, *keys: str) -> DataFrame:
    """(keys..., row_no, col_no, text) of a column `table`; the header is row -1."""
    rows = F.concat(F.array(F.col("table.header")), F.col("table.rows"))
    return tables.select(*keys, F.posexplode(rows).alias("r", "cells")).select(*keys, (F.col("r") - 1).alias("row_no"), F.posexplode("cells").alias("col_no", "text"))


def parsed(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, tables, text, more...): a document's tables in order, its text blocks joined by blank lines. One row for each row of docs; nothing is shuffled."""
    own = docs.select("doc_id", block_array(F.col("text")).alias("b"), *more)
    text = F.array_join(F.transform(F.filter("b", lambda x: x["kind"] == "text"), lambda x: x["text"]), "\n\n")
    tables = F.transform(F.filter("b", lambda x: x["kind"] == "table"), lambda x: x["table"])
    return own.select("doc_id", *own.columns[2:], tables.cast(f"array<{TABLE}>").alias("tables"), F.when(text == "", F.lit("")).otherwise(F.concat(F.regexp_replace(text, rf"{WHITE}+\z", ""), F.lit("\n"))).alias("text"))
