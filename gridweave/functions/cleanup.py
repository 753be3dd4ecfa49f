"""Ordered dictionary replacement: each pair in turn, every occurrence, later pairs see what earlier ones wrote."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import table

_known: dict[str, list[tuple[str, str]]] = {}


def load_corrections(path: str | os.PathLike | None) -> list[tuple[str, str]]:
    """(wrong, right) in file order; a missing, invalid or non-object file has none. Driver-side configuration, read once for each path."""
    key = str(path)
    if key not in _known:
        try:
            with open(key, encoding="utf-8") as f:
                found = json.load(f)
        except (OSError, ValueError):
            found = None
        _known[key] = [(str(k), str(v)) for k, v in found.items()] if isinstance(found, dict) else []
    return _known[key]


def corrected(text: Column, pairs: list[tuple[str, str]]) -> Column:
    pairs = [p for p in pairs if p[0]]
    if not pairs:
        return text
    known = F.array(*[F.struct(F.lit(a).alias("wrong"), F.lit(b).alias("right")) for a, b in pairs])  # folds to one constant
    return F.aggregate(known, text, lambda x, p: F.replace(x, p["wrong"], p["right"]))


def corrected_table(t: Column, pairs: list[tuple[str, str]], columns: list[str] | None = None) -> Column:
    """Cells (of the named columns, or all) corrected; names never are, nor are columns whose name occurs twice."""
    if not pairs:
        return t

    def fix(x: Column, i: Column) -> Column:
        name = F.get(t["header"], i)
        once = F.size(F.filter(t["header"], lambda h: h == name)) == 1
        wanted = once if columns is None else once & name.isin(columns)
        return F.when(wanted, corrected(x, pairs)).otherwise(x)

    return table(t["header"], F.transform(t["rows"], lambda r: F.transform(r, fix)))


def fixes(before: Column, after: Column) -> Column:
    """How many cells differ between two tables of one shape."""
    changed = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: (x != y).cast("long")), F.lit(0).cast("long"), lambda n, x: n + x)
    return F.aggregate(F.zip_with(before["rows"], after["rows"], changed), F.lit(0).cast("long"), lambda n, x: n + x)
