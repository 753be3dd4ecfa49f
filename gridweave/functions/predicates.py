"""Predicates over strings, rows and headers.

The patterns below are fixed values; each means the same in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import at, count_where, let
from .text import squeezed, stripped

SEPARATOR = r"^\s*\|?\s*:?-{2,}:?\s*(\|\s*:?-{2,}:?\s*)+\|?\s*$"
OUTLINE_CODE = r"\A(?:(?i:[IVXLCDM]+)|\p{Nd}+(?:\.\p{Nd}+)*)\z"
MONEY_LIKE = r"\A(?:-?\p{Nd}{1,3}(?:[.,]\p{Nd}{3})+(?:[.,]\p{Nd}+)?|-?\p{Nd}+[.,]\p{Nd}{1,2})\z"
GENERIC_HEADER = r"\A(?i:col(?:_\p{Nd}+)?|Column_\p{Nd}+)\z"
COLUMN_CODE = r"\A(?:[A-Za-z]|[0-9]{1,2})\z"
GARBLE_HINT = r"(?iu)hoyết|qhyết|Erở|ĐƑT|thăng\)|gôm cả|thí hãnh|ĐÓI CHIẾU"
NUMBER_LIKE = r"^[\p{Nd}.,]+$"
ROW_CODE = r"\A(?i:[\p{Nd}IVXLCDM./⁄-]+)\z"
PROSE_MONEY = r"\p{Nd}{1,3}(?:\.\p{Nd}{3}){2,}"
PROSE_OUTLINE = r"^(?:[IVX]+|\p{Nd}+(?:[./⁄]\p{Nd}+)*)(?:\s|$)"
PROSE_CODE = r"\A[A-G1-7]\z"


def has_pipe(line: Column) -> Column:
    return line.contains("|")


def is_separator(line: Column) -> Column:
    return line.rlike(SEPARATOR)


def is_table_row(line: Column) -> Column:
    return has_pipe(line) & (stripped(line) != "")


def is_table_start(line: Column, before: Column, behind: Column) -> Column:
    """before, behind: the neighbouring lines, null at the ends."""
    opens = ~F.coalesce(has_pipe(before), F.lit(False)) & F.coalesce(is_table_row(behind), F.lit(False))
    return has_pipe(line) & F.when(is_separator(line), opens).otherwise(F.coalesce(is_separator(behind), F.lit(False)))


def is_outline_code(text: Column) -> Column:
    return squeezed(text).rlike(OUTLINE_CODE)


def is_money_like(text: Column) -> Column:
    return squeezed(text).rlike(MONEY_LIKE)


def is_generic_header(name: Column) -> Column:
    return squeezed(name).rlike(GENERIC_HEADER)


def headers_are_generic(header: Column) -> Column:
    return (F.size(header) > 0) & F.forall(header, is_generic_header)


def filled(row: Column) -> Column:
    """The row's cells that aren't blank, stripped."""
    return F.filter(F.transform(row, stripped), lambda c: c != "")


def is_code_row(row: Column) -> Column:
    """A row of column codes such as A, B, 1, 2, 3."""
    return let(filled(row), lambda c: (F.size(c) >= 3) & (count_where(c, lambda x: x.rlike(COLUMN_CODE)) >= 0.8 * F.size(c)))


def is_label_row(row: Column) -> Column:
    """A row that still holds header labels: words, no code, no amount."""
    plain = let(filled(row), lambda c: (F.size(c) >= 2) & ~F.exists(c, lambda x: is_money_like(x) | is_outline_code(x)) & (count_where(c, lambda x: F.length(x) >= 3) >= 2))
    return (F.size(row) > 0) & ~is_outline_code(at(row, 0)) & ~is_money_like(at(row, 0)) & plain


def is_headerless_row(row: Column) -> Column:
    """A first row that is data already: a code, then a long text, then short cells."""
    code, text, size = stripped(at(row, 0)), stripped(at(row, 1)), F.size(row)
    short = count_where(F.slice(row, F.lit(3), F.greatest(size, F.lit(1))), lambda c: F.length(stripped(c)) <= 3)
    return (size >= 2) & code.rlike(ROW_CODE) & (F.length(text) >= 12) & (short >= F.greatest(F.lit(1), size - 3))


def is_noise_row(row: Column) -> Column:
    def test(c: Column) -> Column:
        n, tiny = F.size(c), count_where(c, lambda x: F.length(x) <= 2)
        letters = (n >= 3) & (tiny == n) & ~F.exists(c, lambda x: x.rlike(r"\p{Nd}"))
        return letters | ((n >= 4) & (tiny >= F.greatest(F.lit(4), n - 1)) & ~F.exists(c, lambda x: F.length(x) >= 8))

    return let(filled(row), test)


def is_subheader_row(row: Column) -> Column:
    """row: padded. Blank identifiers in front, labels behind."""
    behind = F.filter(F.transform(F.slice(row, F.lit(4), F.greatest(F.size(row), F.lit(1))), stripped), lambda c: c != "")
    blank = count_where(F.slice(row, 1, 3), lambda c: stripped(c) == "")
    return (blank >= 2) & (F.size(behind) >= 2) & F.exists(behind, lambda c: F.length(c) >= 3)


def is_mostly_empty(row: Column, share: float = 0.6) -> Column:
    """row: padded."""
    n = F.size(row)
    return (n == 0) | (count_where(row, lambda c: stripped(c) == "") / n >= share)


def is_garbled(header: Column) -> Column:
    """Header text that looks like a recognition error."""
    joined = F.array_join(header, " ")
    tokens = F.filter(F.split(joined, r"[\s\p{Z}]+", -1), lambda t: t != "")
    return (F.size(header) == 0) | joined.rlike(GARBLE_HINT) | let(tokens, lambda t: (F.size(t) >= 4) & (count_where(t, lambda x: F.length(x) <= 2) >= 0.45 * F.size(t)))


def is_tableish(line: Column) -> Column:
    """line: stripped."""
    return (line != "") & (line.rlike(PROSE_MONEY) | line.rlike(PROSE_OUTLINE) | has_pipe(line) | line.rlike(PROSE_CODE))


def is_placeholder(t: Column) -> Column:
    """A sheet that only says that there are no tables."""
    return (F.size(t["header"]) == 1) & (at(t["header"], 0) == "info") & (F.size(t["rows"]) == 1) & at(F.get(t["rows"], F.lit(0)), 0).contains("No tables")


def is_empty(t: Column) -> Column:
    return t.isNull() | (F.size(t["rows"]) == 0) | (F.size(t["header"]) == 0)
