"""Repair of form tables: false headers, sparse headers, header rows in the body, shifted cells, several numbers in a cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import at, fitted, indexes, leading, let, lets, rest, table
from .names import generic_names
from .predicates import NUMBER_LIKE, headers_are_generic, is_code_row, is_empty, is_generic_header, is_label_row, is_money_like, is_outline_code
from .text import cell_text, squeezed


def cleaned(t: Column) -> Column:
    """Cells and names with white space squeezed; rows as wide as the header."""
    width = F.size(t["header"])
    return table(F.transform(t["header"], squeezed), F.transform(t["rows"], lambda r: F.transform(fitted(r, width), squeezed)))


def demote_false_header(t: Column) -> Column:
    """A header that is a data row (code, description, generic names) goes back to the body."""

    def demoted(t: Column, h: Column) -> Column:
        second, tail = at(h, 1), F.slice(h, F.lit(3), F.greatest(F.size(h), F.lit(1)))
        described = (second != "") & ~is_outline_code(second) & ~is_money_like(second) & (F.length(second) >= 6)
        generic = F.size(F.filter(tail, lambda x: (x == "") | is_generic_header(x)))
        false = is_outline_code(at(h, 0)) & described & ((F.size(tail) == 0) | (generic / F.size(tail) >= 0.5))
        first = F.transform(h, lambda x: F.when(is_generic_header(x), F.lit("")).otherwise(x))
        return F.when(false, table(generic_names(F.size(h)), F.concat(F.array(first), cleaned(t)["rows"]))).otherwise(t)

    return lets(t, lambda t: F.transform(t["header"], squeezed), demoted)


def _compacted(h: Column) -> Column:
    """Names slid to the left if the first is blank, not all are generic and there are two or more."""
    some = F.filter(h, lambda x: x != "")
    return F.when((F.size(h) > 0) & (at(h, 0) == "") & ~headers_are_generic(h) & (F.size(some) >= 2), F.concat(some, F.array_repeat(F.lit(""), F.size(h) - F.size(some)))).otherwise(h)


def compact_header(t: Column) -> Column:
    """Blank names in front: the others slide left; the body stays."""
    return lets(t, lambda t: F.transform(t["header"], squeezed), lambda t, h: let(_compacted(h), lambda c: F.when(c == h, t).otherwise(table(c, t["rows"]))))


def absorb_header_rows(t: Column) -> Column:
    """Leading label rows fill blank or generic names in order, leading code rows are appended to the names."""

    def slot(x: Column) -> Column:
        return (x == "") | is_generic_header(x)

    def absorbed(t: Column, m: Column, n: Column) -> Column:
        front = F.slice(m["rows"], F.lit(1), n)
        codes, labels = F.filter(front, is_code_row), F.flatten(F.transform(F.filter(front, lambda r: ~is_code_row(r)), lambda r: F.filter(r, lambda c: c != "")))

        def labelled(h: Column, found: Column) -> Column:
            return F.transform(h, lambda x, i: F.when(slot(x), F.coalesce(F.get(found, F.size(F.filter(F.slice(h, F.lit(1), i), slot))), x)).otherwise(x))

        def coded(h: Column, rows: Column) -> Column:
            def add(name: Column, code: Column) -> Column:
                return F.when(code == "", name).when(slot(name), code).when(F.array_contains(F.split(name, " "), code), name).otherwise(F.concat_ws(" ", name, code))

            return F.transform(h, lambda x, i: F.aggregate(rows, x, lambda name, r: add(name, at(r, i))))

        def named(h: Column) -> Column:
            return F.transform(h, lambda x, i: F.when(x == "", F.concat(F.lit("Column_"), (i + 1).cast("string"))).otherwise(x))

        header = lets(_compacted(m["header"]), labels, labelled)
        return F.when(n == 0, t).otherwise(table(named(lets(header, codes, coded)), rest(m["rows"], n)))

    return let(t, lambda t: F.when(is_empty(t), t).otherwise(lets(cleaned(t), lambda m: leading(m["rows"], lambda r: is_code_row(r) | is_label_row(r)), lambda m, n: absorbed(t, m, n))))


def realign_rows(t: Column) -> Column:
    """An amount in front of a code goes to the first blank cell from the third on; a row that begins one cell late moves left."""

    def realigned(row: Column, width: Column) -> Column:
        def leaked(moved: Column) -> Column:
            # The move leaves the last cell blank, so there is a blank cell from the third on unless there are two columns only.
            blank = F.filter(indexes(width), lambda i: (i >= 2) & (at(moved, i) == ""))
            return F.when(F.size(blank) == 0, moved).otherwise(F.transform(moved, lambda x, i: F.when(i == F.get(blank, F.lit(0)), at(row, 0)).otherwise(x)))

        left = fitted(rest(row, F.lit(1)), width)
        code = is_outline_code(at(row, 1))
        late = (at(row, 0) == "") & code & (width >= 3) & (at(row, 2) != "") & ~is_outline_code(at(row, 2)) & ~is_money_like(at(row, 2))
        return F.when(is_money_like(at(row, 0)) & code, let(left, leaked)).when(late, left).otherwise(row)

    def apply(t: Column, m: Column) -> Column:
        return F.when(is_empty(t) | (F.size(t["header"]) < 2), t).otherwise(table(m["header"], F.transform(m["rows"], lambda r: realigned(r, F.size(m["header"])))))

    return lets(t, cleaned, apply)


def repair(t: Column) -> Column:
    """All repairs, in the order in which they build on each other."""
    return lets(t, demote_false_header, lambda _, x: absorb_header_rows(x), lambda _, __, x: compact_header(x), lambda *x: realign_rows(x[-1]))


def _numbers(cell: Column) -> Column:
    """The cell's parts if it is two or more numbers, otherwise the cell alone."""
    return let(F.split(cell, " ", -1), lambda p: F.when((F.size(p) >= 2) & F.forall(p, lambda x: x.rlike(NUMBER_LIKE)), p).otherwise(F.array(cell)))


def split_multi_value(t: Column) -> Column:
    """A column with a cell of several numbers becomes as many columns as the cell with the most needs."""

    def split(t: Column, cells: Column) -> Column:
        places = indexes(F.size(t["header"]))
        widths = F.transform(places, lambda c: F.greatest(F.lit(1), F.coalesce(F.array_max(F.transform(cells, lambda r: F.size(F.get(r, c)))), F.lit(1))))

        def names(widths: Column) -> Column:
            def add(found: Column, c: Column) -> Column:
                own = F.get(t["header"], c)

                def another(found: Column, k: Column) -> Column:
                    free = F.filter(F.sequence(k, k + F.size(found)), lambda s: ~F.array_contains(found, F.concat_ws("_", own, s.cast("string"))))
                    return F.concat(found, F.array(F.concat_ws("_", own, F.get(free, F.lit(0)).cast("string"))))

                more = F.when(F.get(widths, c) >= 2, F.sequence(F.lit(2), F.get(widths, c))).otherwise(F.array().cast("array<int>"))
                return F.aggregate(more, F.concat(found, F.array(own)), another)

            return F.aggregate(places, F.array().cast("array<string>"), add)

        return let(widths, lambda w: table(names(w), F.transform(cells, lambda r: F.flatten(F.transform(r, lambda parts, c: fitted(parts, F.get(w, c)))))))

    return lets(t, lambda t: F.transform(t["rows"], lambda r: F.transform(fitted(r, F.size(t["header"])), lambda x: _numbers(cell_text(x)))), split)
