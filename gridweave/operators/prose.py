"""Prose of pages without a document model: leading lines up to the first table-like one, and lines that look like signatures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import leading, let, lets
from ..functions.predicates import is_tableish
from ..functions.text import joined_lines, name_letters, split_lines, stripped

#: Leading lines, trailing lines, letters of a line that counts.
HEADER_LINES, FOOTER_LINES, LEAST_LETTERS = 24, 5, 6


def _lines(text: Column) -> Column:
    return F.transform(split_lines(F.coalesce(text, F.lit(""))), stripped)


def header_lines(text: Column, most: int = HEADER_LINES) -> Column:
    """Lines up to the first table-like one or the most-th that isn't blank."""

    def kept(lines: Column) -> Column:
        front = F.slice(lines, F.lit(1), leading(lines, lambda x: ~is_tableish(x)))
        number = F.filter(F.transform(front, lambda x, i: F.when(x != "", i)), lambda i: i.isNotNull())
        return let(front, lambda f: F.slice(f, F.lit(1), F.coalesce(F.get(number, F.lit(most - 1)) + 1, F.size(f))))

    return joined_lines(let(_lines(text), kept))


def clean_footer(text: Column) -> Column:
    """Lines with enough letters that aren't table-like."""
    return joined_lines(F.filter(_lines(text), lambda x: (x != "") & ~is_tableish(x) & (name_letters(x) >= LEAST_LETTERS)))


def _trailing(text: Column) -> Column:
    """The last lines with enough letters, back to a blank line behind one of them or to a table-like line."""

    def taken(lines: Column) -> Column:
        counts = lambda x: (x != "") & (name_letters(x) >= LEAST_LETTERS)
        upto = F.slice(lines, F.lit(1), leading(lines, lambda x: ~is_tableish(x)))
        first = F.get(F.filter(F.transform(upto, lambda x, i: F.when(counts(x), i)), lambda i: i.isNotNull()), F.lit(0))
        stop = F.filter(F.transform(upto, lambda x, i: F.when((x == "") & (i > first), i)), lambda i: i.isNotNull())
        return let(upto, lambda u: F.slice(F.filter(F.slice(u, F.lit(1), F.coalesce(F.get(stop, F.lit(0)), F.size(u))), counts), 1, FOOTER_LINES))

    return joined_lines(F.reverse(let(F.reverse(_lines(text)), taken)))


def finalized(text: Column) -> Column:
    """A document's header lines and trailing lines; the latter only if the header doesn't hold them."""
    both = lambda h, f: F.when((h != "") & (f != "") & h.contains(f), h).otherwise(F.array_join(F.filter(F.array(h, f), lambda x: x != ""), "\n\n"))
    return lets(header_lines(text), _trailing(text), both)


def page_text(pages: DataFrame) -> DataFrame:
    """(doc_id, text) from pages (doc_id, page_no, boxed, full, above, below): above and below are the text around a table box (null where there is no room)."""
    around = F.array_join(F.filter(F.array(header_lines(F.col("above")), clean_footer(F.col("below"))), lambda x: x != ""), "\n\n")
    own = pages.select("doc_id", "page_no", F.when(~F.col("boxed"), header_lines(F.col("full"))).otherwise(around).alias("part"))
    body = own.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_no", "part"))).alias("p"))
    text = F.array_join(F.filter(F.transform("p", lambda x: x["part"]), lambda x: x != ""), "\n\n")
    return body.select("doc_id", finalized(stripped(F.regexp_replace(text, "\n{3,}", "\n\n"))).alias("text"))
