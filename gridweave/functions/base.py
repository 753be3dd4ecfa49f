"""Building blocks for expressions over tables.

A table is one value: struct<header: array<string>, rows: array<array<string>>>. All functions here take and return columns, so
Catalyst sees plain expressions: no Python runs on the executors, and a table never becomes a Spark schema of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

TABLE = "struct<header: array<string>, rows: array<array<string>>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value evaluated once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def lets(*values: Column | Callable) -> Column:
    """let() over several values, each of which may be a function of those before; the last is the body."""

    def bind(k: int, bound: tuple[Column, ...]) -> Column:
        value = values[k](*bound) if callable(values[k]) and not isinstance(values[k], Column) else values[k]
        return value if k == len(values) - 1 else let(value, lambda x: bind(k + 1, (*bound, x)))

    return bind(0, ())


def no_strings() -> Column:
    return F.array().cast("array<string>")


def no_rows() -> Column:
    return F.array().cast("array<array<string>>")


def no_tables() -> Column:
    return F.array().cast(f"array<{TABLE}>")


def table(header: Column, rows: Column) -> Column:
    return F.struct(header.alias("header"), rows.alias("rows")).cast(TABLE)


def count_where(items: Column, test: Callable) -> Column:
    return F.size(F.filter(items, test))


def at(items: Column, i: Column | int) -> Column:
    """The item at a 0-based place, '' where there is none."""
    return F.coalesce(F.get(items, F.lit(i) if isinstance(i, int) else i), F.lit(""))


def leading(items: Column, test: Callable) -> Column:
    """How many items at the front pass the test."""
    return let(F.array_position(F.transform(items, lambda x: ~test(x)), True), lambda k: F.when(k == 0, F.size(items)).otherwise(k - 1)).cast("int")


def fitted(row: Column, width: Column) -> Column:
    """The row with '' appended up to the width, or cut to it."""
    return F.slice(F.concat(row, F.array_repeat(F.lit(""), F.greatest(width - F.size(row), F.lit(0)))), F.lit(1), width)


def rest(items: Column, skip: Column) -> Column:
    """The items behind the first `skip`."""
    return F.slice(items, skip + 1, F.greatest(F.size(items) - skip, F.lit(0)))


def indexes(n: Column) -> Column:
    """0 to n - 1; none for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def widest(rows: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0))
