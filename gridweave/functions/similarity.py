"""How well an extracted table matches a table of the document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import let, lets
from .predicates import headers_are_generic
from .text import cell_text, squeezed, tokens

#: Rows that a table's tokens are taken from, and the least score of a match (fixed values).
SAMPLE_ROWS, LEAST_SCORE = 8, 0.45


def sample_tokens(t: Column) -> Column:
    """Distinct lower-case tokens of the header and the first rows."""
    cells = F.concat(t["header"], F.flatten(F.slice(t["rows"], 1, SAMPLE_ROWS)))
    return F.array_distinct(F.flatten(F.transform(cells, lambda c: tokens(cell_text(c)))))


def jaccard(a: Column, b: Column) -> Column:
    """0 if either set is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def column_score(m: Column, e: Column) -> Column:
    ratio = F.least(m, e) / F.greatest(m, e)
    return F.when(m == e, F.lit(1.0)).when(F.abs(m - e) == 1, 0.7 * ratio).otherwise(0.35 * ratio)


def row_score(m: Column, e: Column) -> Column:
    """Tables stitched over pages are taller than the document's and lose little by it."""
    ratio = F.least(m, e) / F.greatest(m, e)
    return F.when(F.greatest(m, e) == 0, F.lit(1.0)).when((e > m * 2) & (m > 0), F.greatest(ratio, F.lit(0.55))).otherwise(ratio)


def scored(cols_m: Column, cols_e: Column, rows_m: Column, rows_e: Column, content: Column) -> Column:
    score = 0.5 * column_score(cols_m, cols_e) + 0.25 * row_score(rows_m, rows_e) + 0.25 * content
    return F.when((cols_m == 0) | (cols_e == 0), F.lit(0.0)).otherwise(score)


def similarity(m: Column, e: Column, tokens_m: Column | None = None, tokens_e: Column | None = None) -> Column:
    content = lets(tokens_m if tokens_m is not None else sample_tokens(m), tokens_e if tokens_e is not None else sample_tokens(e), jaccard)
    return scored(F.size(m["header"]), F.size(e["header"]), F.size(m["rows"]), F.size(e["rows"]), content)


def headers_compatible(a: Column, b: Column) -> Column:
    """May a table with header b continue one with header a?"""

    def test(x: Column, y: Column) -> Column:
        words = lambda h: F.array_distinct(F.filter(F.flatten(F.transform(h, lambda c: F.split(c, " "))), lambda w: w != ""))
        matches = F.size(F.filter(F.zip_with(x, y, lambda p, q: (p != "") & (p == q)), lambda z: z))
        overlap = lets(words(x), words(y), lambda p, q: F.size(F.array_intersect(p, q)) / F.greatest(F.lit(1), F.size(F.array_union(p, q))))
        alike = (matches >= F.greatest(F.lit(1), F.floor(F.size(x) / 2))) | (overlap >= 0.5)
        return (F.size(x) > 0) & (F.size(x) == F.size(y)) & (headers_are_generic(x) | headers_are_generic(y) | alike)

    low = lambda h: F.transform(h, lambda c: squeezed(F.lower(c)))
    return let(F.struct(low(a).alias("x"), low(b).alias("y")), lambda s: test(s["x"], s["y"]))
