"""Left folds over a document's tables and blocks.

Whether a table goes on with the one before it depends on what has been joined already, and which extracted table a block takes on what the blocks before it have taken.
Such state can't be unrolled into windows, and as nested aggregate() expressions it exceeds what the analyzer resolves. So these folds run in Arrow batches, a
document at a time, on the same values (header, rows) as the expressions; functions.layout, functions.similarity and this module hold the same rules, and tests keep
them equal.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.base import TABLE
from ..functions.predicates import COLUMN_CODE, GARBLE_HINT, GENERIC_HEADER, MONEY_LIKE, NUMBER_LIKE, OUTLINE_CODE
from ..functions.similarity import LEAST_SCORE, SAMPLE_ROWS
from ..shipping import ship

Table = tuple[list[str], list[list[str]]]


def _pattern(java: str, flags: int = 0) -> re.Pattern:
    return re.compile(java.replace(r"\p{Nd}", r"\d").replace(r"\z", r"\Z").replace("(?iu)", ""), flags)


_OUTLINE, _MONEY, _GENERIC, _CODE, _NUMBER = map(_pattern, (OUTLINE_CODE, MONEY_LIKE, GENERIC_HEADER, COLUMN_CODE, NUMBER_LIKE))
_GARBLE, _TOKEN, _BREAK = _pattern(GARBLE_HINT, re.IGNORECASE), re.compile(r"[\w./%+-]+"), re.compile("<br>|<br/>|<br />")


def squeeze(x: str | None) -> str:
    return " ".join((x or "").split())


def cell(x: str | None) -> str:
    return squeeze(_BREAK.sub(" ", x or ""))


def fit(row: list[str], n: int) -> list[str]:
    return row[:n] + [""] * (n - len(row))


def outline(x: str) -> bool:
    return bool(_OUTLINE.match(squeeze(x)))


def money(x: str) -> bool:
    return bool(_MONEY.match(squeeze(x)))


def generic(x: str) -> bool:
    return bool(_GENERIC.match(squeeze(x)))


def all_generic(header: list[str]) -> bool:
    return bool(header) and all(map(generic, header))


def cleaned(t: Table) -> Table:
    return [squeeze(x) for x in t[0]], [[squeeze(x) for x in fit(r, len(t[0]))] for r in t[1]]


def empty(t: Table) -> bool:
    return not t[0] or not t[1]


def garbled(header: list[str]) -> bool:
    tokens = " ".join(header).split()
    return not header or bool(_GARBLE.search(" ".join(header))) or len(tokens) >= 4 and sum(len(x) <= 2 for x in tokens) >= 0.45 * len(tokens)


def demote(t: Table) -> Table:
    h = [squeeze(x) for x in t[0]]
    if len(h) < 2 or not outline(h[0]) or len(h[1]) < 6 or outline(h[1]) or money(h[1]):
        return t
    tail = h[2:]
    if tail and sum(not x or generic(x) for x in tail) < 0.5 * len(tail):
        return t
    return [f"Column_{k}" for k in range(1, len(h) + 1)], [["" if generic(x) else x for x in h], *cleaned(t)[1]]


def compacted(h: list[str]) -> list[str]:
    some = [x for x in h if x]
    return some + [""] * (len(h) - len(some)) if h and not h[0] and not all_generic(h) and len(some) >= 2 else h


def compact(t: Table) -> Table:
    h = [squeeze(x) for x in t[0]]
    return t if (c := compacted(h)) == h else (c, t[1])


def is_code_row(row: list[str]) -> bool:
    own = [x for x in row if x]
    return len(own) >= 3 and sum(bool(_CODE.match(x)) for x in own) >= 0.8 * len(own)


def is_label_row(row: list[str]) -> bool:
    own = [x for x in row if x]
    return len(own) >= 2 and not any(outline(x) or money(x) for x in own) and sum(len(x) >= 3 for x in own) >= 2


def absorb(t: Table) -> Table:
    if empty(t):
        return t
    h, rows = cleaned(t)
    n = next((k for k, r in enumerate(rows) if not is_code_row(r) and not is_label_row(r)), len(rows))
    if not n:
        return t
    codes = [r for r in rows[:n] if is_code_row(r)]
    labels = iter([x for r in rows[:n] if not is_code_row(r) for x in r if x])
    slot = lambda x: not x or generic(x)
    h = [next(labels, x) if slot(x) else x for x in compacted(h)]
    for row in codes:
        h = [x if not c else c if slot(x) else x if c in x.split() else f"{x} {c}" for x, c in zip(h, row, strict=True)]
    return [x or f"Column_{k}" for k, x in enumerate(h, 1)], rows[n:]


def realign(t: Table) -> Table:
    if empty(t) or len(t[0]) < 2:
        return t
    h, rows = cleaned(t)
    out = []
    for r in rows:
        left = r[1:] + [""]
        if outline(r[1]) and money(r[0]):
            blank = next((k for k in range(2, len(h)) if not left[k]), None)
            out.append(left if blank is None else left[:blank] + [r[0]] + left[blank + 1 :])
        elif outline(r[1]) and not r[0] and len(h) >= 3 and r[2] and not outline(r[2]) and not money(r[2]):
            out.append(left)
        else:
            out.append(r)
    return h, out


def repair(t: Table) -> Table:
    return realign(compact(absorb(demote(t))))


def split_values(t: Table) -> Table:
    def parts(x: str) -> list[str]:
        p = cell(x).split(" ")
        return p if len(p) >= 2 and all(map(_NUMBER.match, p)) else [cell(x)]

    cells = [[parts(x) for x in fit(r, len(t[0]))] for r in t[1]]
    names, widths = [], [max([1, *(len(r[c]) for r in cells)]) for c in range(len(t[0]))]
    for name, n in zip(t[0], widths, strict=True):
        names.append(name)
        for k in range(2, n + 1):
            while f"{name}_{k}" in names:
                k += 1
            names.append(f"{name}_{k}")
    return names, [[x for p, n in zip(r, widths, strict=True) for x in fit(p, n)] for r in cells]


def _row_codes(rows: list[list[str]]) -> list[str]:
    return [r[0] if outline(r[0]) else r[1] for r in rows if r and (outline(r[0]) or len(r) > 1 and not r[0] and outline(r[1]))]


def outline_key(code: str) -> tuple:
    s = squeeze(code).upper()
    return (0, tuple(map(int, s.split("."))), "") if s[:1].isdigit() else (1, (), s)


def continues(prev: Table, nxt: Table) -> bool:
    if not nxt[0] or len(prev[0]) != len(nxt[0]):
        return False
    (_, a), (h, b) = cleaned(prev), cleaned(nxt)
    last, first = _row_codes(a), [h[0]] if outline(h[0]) else _row_codes(b)
    if not last or not first or outline_key(first[0]) < outline_key(last[-1]):
        return False
    return outline(h[0]) or all_generic(h) or sum(not x or generic(x) for x in h) >= 0.4 * len(h)


def joined(prev: Table, nxt: Table) -> Table:
    left, right = repair(prev), repair(nxt)
    h = [squeeze(x) for x in right[0]]
    if h and outline(h[0]) and not all_generic(h):
        right = demote(right)
    return left[0], left[1] + [fit(r, len(left[0])) for r in cleaned(right)[1]]


def compatible(a: list[str], b: list[str]) -> bool:
    x, y = ([squeeze(c.lower()) for c in h] for h in (a, b))
    if not x or len(x) != len(y):
        return False
    if all_generic(x) or all_generic(y):
        return True
    words = [{w for c in h for w in c.split()} for h in (x, y)]
    return sum(p == q != "" for p, q in zip(x, y, strict=True)) >= max(1, len(x) // 2) or len(words[0] & words[1]) >= 0.5 * max(1, len(words[0] | words[1]))


def stitch_outline(tables: list[Table]) -> list[Table]:
    if len(tables) <= 1:
        return tables
    done = [repair(tables[0])]
    for t in map(repair, tables[1:]):
        if continues(done[-1], t):
            done[-1] = joined(done[-1], t)
        else:
            done.append(t)
    return done


def stitch_responses(tables: list[Table]) -> list[Table]:
    done = tables[:1]
    for t in tables[1:]:
        prev = done[-1]
        if compatible(prev[0], t[0]):
            done[-1] = (prev[0], prev[1] + t[1])
        elif continues(prev, t) and len((fixed := repair(t))[0]) == len(prev[0]):
            done[-1] = (prev[0], prev[1] + fixed[1])
        else:
            done.append(t)
    return done


def sample(t: Table) -> set[str]:
    return {w for x in [*t[0], *(x for r in t[1][:SAMPLE_ROWS] for x in r)] for w in _TOKEN.findall(cell(x).lower())}


def score(m: Table, e: Table, a: set[str], b: set[str]) -> float:
    mc, ec, mr, er = len(m[0]), len(e[0]), len(m[1]), len(e[1])
    if not mc or not ec:
        return 0.0
    ratio = min(mc, ec) / max(mc, ec)
    cols = 1.0 if mc == ec else (0.7 if abs(mc - ec) == 1 else 0.35) * ratio
    rows = min(mr, er) / max(mr, er) if max(mr, er) else 1.0
    rows = max(rows, 0.55) if er > 2 * mr > 0 else rows
    return 0.5 * cols + 0.25 * rows + 0.25 * (len(a & b) / len(a | b) if a and b else 0.0)


def merge_form(m: Table, e: Table) -> Table:
    own = [cell(x) for x in e[0]]
    for form in (m, split_values(m)):
        if own and len(form[0]) == len(own):
            return [cell(x) for x in form[0]] if all_generic(own) else own, [[cell(x) for x in fit(r, len(own))] for r in e[1]]
    return e if garbled([cell(x) for x in m[0]]) or len(m[0]) < len(own) else m


def assemble(blocks: list[tuple[str, str | None, Table | None]], extracted: list[Table], fix: Callable[[str], str]) -> list[tuple[str, str | None, Table | None]]:
    """blocks: (kind, plain text, table) in reading order; the document's parts, likewise."""
    tokens, given = [sample(t) for t in extracted], [0] * len(extracted)
    open_, used = [True] * len(extracted), [False] * len(extracted)
    forms = [t for kind, _, t in blocks if kind == "table"]
    bad = [garbled([cell(x) for x in t[0]]) for t in forms]

    def prepared(t: Table) -> Table:
        h, rows = repair(split_values(t))
        once = [h.count(x) == 1 for x in h]
        return h, [[fix(x) if ok else x for x, ok in zip(r, once, strict=True)] for r in rows]

    def chosen(form: Table, is_bad: bool) -> Table:
        own, free = sample(form), [k for k, x in enumerate(open_) if x]
        scores = {k: score(form, extracted[k], own, tokens[k]) for k in free}
        k = max(free, key=lambda k: (scores[k], -k), default=None)
        if k is None or scores[k] < LEAST_SCORE:
            if k is None or not is_bad:
                return form
            k = free[0]
        used[k] = True
        header, rows = extracted[k]
        if len(forms) > 1 and len(header) == len(form[0]):
            start, need = given[k], max(len(form[1]), 1)
            end = len(rows) if len(rows) - start <= need + 2 else start + need
            part = (header if all_generic([cell(x) for x in form[0]]) else form[0], rows[start:end])
            given[k] = max(start, end)
        else:
            part, given[k] = (header, rows), len(rows)
        open_[k] = given[k] < len(rows)
        return form if empty(part) else merge_form(form, part)

    parts, at = [], iter(bad)
    for kind, text, t in blocks:
        if kind == "text":
            if (fixed := fix(text or "")).strip():
                parts.append((kind, fixed, None))
        else:
            parts.append((kind, None, prepared(chosen(t, next(at)))))
    if not forms or any(bad):
        parts += [("table", None, prepared(t)) for t, o, u in zip(extracted, open_, used, strict=True) if o and not u]
    out = []
    for kind, run in groupby(parts, key=lambda p: p[0]):
        out += run if kind == "text" else [("table", None, t) for t in stitch_outline([p[2] for p in run])]
    return out


_TABLES = pa.list_(pa.struct([("header", pa.list_(pa.string())), ("rows", pa.list_(pa.list_(pa.string())))]))
BLOCK = f"struct<kind: string, text: string, table: {TABLE}>"
_BLOCKS = pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string()), ("table", _TABLES.value_type)]))


def _plain(t: dict | None) -> Table | None:
    return None if t is None else (t["header"], t["rows"])


def _packed(t: Table | None) -> dict | None:
    return None if t is None else {"header": t[0], "rows": t[1]}


def fold_tables(tables: Column, fold: Callable[[list[Table]], list[Table]]) -> Column:
    """fold over an array of tables."""
    ship()

    @F.arrow_udf(f"array<{TABLE}>")
    def folded(column: pa.Array) -> pa.Array:
        return pa.array([[_packed(t) for t in fold([_plain(t) for t in own or []])] for own in column.to_pylist()], _TABLES)

    return folded(tables)


def fold_document(blocks: Column, extracted: Column, pairs: list[tuple[str, str]]) -> Column:
    """assemble() over an array of blocks (texts are plain already) and an array of tables."""
    ship()

    def fix(x: str) -> str:
        for wrong, right in pairs:
            if wrong and wrong in x:
                x = x.replace(wrong, right)
        return x

    @F.arrow_udf(f"array<{BLOCK}>")
    def folded(b: pa.Array, e: pa.Array) -> pa.Array:
        rows = [assemble([(x["kind"], x["text"], _plain(x["table"])) for x in own], [_plain(t) for t in found], fix) for own, found in zip(b.to_pylist(), e.to_pylist(), strict=True)]
        return pa.array([[{"kind": k, "text": x, "table": _packed(t)} for k, x, t in own] for own in rows], _BLOCKS)

    return folded(blocks, extracted)
