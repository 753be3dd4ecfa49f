"""Text rules: lines, white space, cells, headers, prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import let, no_strings

LINE_END = "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]"
WHITE = r"[\s\p{Z}\x1c-\x1f\x85]"
TOKEN = r"[\p{L}\p{N}_./%+-]+"
IMAGE = r"!\[[^\]]*\]\([^)]+\)"
#: Runs of letters that names are made of (fixed value).
NAME = r"[A-Za-zÀ-ỹĂÂÊÔƠƯăâêôơưĐđ]{3,}"


def split_lines(text: Column) -> Column:
    """Lines without their ends; an end at the text's end opens no further line."""
    return let(F.split(text, LINE_END, -1), lambda x: F.when(F.element_at(x, -1) == "", F.slice(x, F.lit(1), F.size(x) - 1)).otherwise(x))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{WHITE}+|{WHITE}+\z", "")


def squeezed(text: Column) -> Column:
    """No white space at the ends, one space for each run; null is ''."""
    return F.coalesce(F.trim(F.regexp_replace(text, rf"{WHITE}+", " ")), F.lit(""))


def without_breaks(text: Column) -> Column:
    return F.regexp_replace(text, "<br>|<br/>|<br />", " ")


def cell_text(text: Column) -> Column:
    return squeezed(without_breaks(text))


def raw_cell(text: Column) -> Column:
    """Null is '', line feeds are spaces, the ends are stripped; inner white space stays."""
    return stripped(F.coalesce(F.regexp_replace(text, "\n", " "), F.lit("")))


def header_cell(text: Column) -> Column:
    """A header cell's text; '' for the generic names that parsers make up."""
    return let(squeezed(without_breaks(text)), lambda x: F.when(F.lower(x).isin("col", "col_1", "col_2", "col_3", "col_4"), F.lit("")).otherwise(x))


def split_row(line: Column) -> Column:
    """The cells of a pipe row; one border pipe at each end is dropped."""
    inner = F.regexp_replace(F.regexp_replace(stripped(line), r"\A\|", ""), r"\|\z", "")
    return F.transform(F.split(inner, r"\|", -1), stripped)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN})"), F.lit(1))


def markdown_to_plain(text: Column) -> Column:
    """Prose without headings' marks, images and line breaks of HTML; at most one blank line in a row."""

    def plain(line: Column) -> Column:
        clean = stripped(without_breaks(F.regexp_replace(F.regexp_replace(line, IMAGE, ""), r"\A#+\s*", "")))
        return F.when(line == "", no_strings_of("")).when(clean == "", no_strings()).otherwise(F.array(clean))

    lines = F.flatten(F.transform(F.transform(split_lines(text), stripped), plain))
    return stripped(F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n"))


def no_strings_of(x: str) -> Column:
    return F.array(F.lit(x))


def name_letters(line: Column) -> Column:
    """How many letters the line's longer words have together."""
    return F.length(F.array_join(F.regexp_extract_all(line, F.lit(f"({NAME})"), F.lit(1)), ""))


def joined_lines(lines: Column) -> Column:
    return stripped(F.array_join(lines, "\n"))


def plaintext_as_markdown(text: Column) -> Column:
    return stripped(text)
