"""Unique column names, in the three conventions that table sources use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import indexes, let, rest
from .text import raw_cell, stripped


def _numbered(names: Column, first: int) -> Column:
    """A name's later occurrences get _first, _first+1, ...; equal names are brought together by sorting."""

    def number(p: Column) -> Column:
        new = lambda i: (i == 0) | ~F.get(p, i - 1)["x"].eqNullSafe(F.get(p, i)["x"])
        starts = F.filter(indexes(F.size(p)), new)
        runs = let(starts, lambda s: F.zip_with(s, F.concat(rest(s, F.lit(1)), F.array(F.size(p))), lambda lo, hi: indexes(hi - lo)))
        named = F.zip_with(p, F.flatten(runs), lambda z, k: F.struct(z["i"].alias("i"), F.when(k == 0, z["x"]).otherwise(F.concat(z["x"], F.lit("_"), (k + (first - 1)).cast("string"))).alias("x")))
        return F.transform(F.sort_array(named), lambda z: z["x"])

    return let(F.sort_array(F.transform(names, lambda x, i: F.struct(x.alias("x"), i.alias("i")))), number)


def parser_names(header: Column) -> Column:
    """Blank is `col`; the second `x` is `x_1`."""
    return _numbered(F.transform(header, lambda x: F.when(stripped(x) == "", F.lit("col")).otherwise(stripped(x))), 1)


def grid_names(header: Column) -> Column:
    """Blank is `Column_<place>`; the second `x` is `x_2`."""
    return _numbered(F.transform(header, lambda x, i: F.when(raw_cell(x) == "", F.concat(F.lit("Column_"), (i + 1).cast("string"))).otherwise(raw_cell(x))), 2)


def response_names(header: Column) -> Column:
    """Blank is `Column`; the second `x` is `x_2`."""
    return _numbered(F.transform(header, lambda x: F.when(x == "", F.lit("Column")).otherwise(x)), 2)


def generic_names(width: Column) -> Column:
    """Column_1, Column_2, ..."""
    return F.when(width > 0, F.transform(F.sequence(F.lit(1), width), lambda i: F.concat(F.lit("Column_"), i.cast("string")))).otherwise(F.array().cast("array<string>"))
