"""Model responses (HTML tables, or JSON in several shapes) as tables.

HTML spans and recursive JSON have no counterpart among expressions, so responses are parsed in Arrow batches with the standard library. Cells
stay the strings they are: `250.000` is never read as a number. A response with no table in HTML is tried as JSON.
"""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import TABLE
from ..shipping import ship

FRAGMENT = re.compile(r"<table\b.*?</table>", re.DOTALL | re.IGNORECASE)
FENCE = re.compile(r"```(?:json)?\s*(.*?)\s*```", re.DOTALL)
Grid = list[list[str]]
Table = tuple[list[str], Grid]

#: What a start tag ends, and what it doesn't look beyond.
_ENDS = {"td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tr": ({"tr"}, {"table"})}
_VOID = {"br", "hr", "img", "input", "col", "meta", "link", "wbr"}


class _Rows(HTMLParser):
    """All tr elements in document order, each with its own cells; a cell's text has that of everything inside it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, dict]] = []
        self.rows: list[list[dict]] = []

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        ends, stop = _ENDS.get(tag, (set(), set()))
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in ends:
                del self.open[k:]
                break
            if self.open[k][0] in stop:
                break
        node: dict = {}
        if tag == "tr":
            self.rows.append([])
            node = {"row": self.rows[-1]}
        elif tag in ("td", "th"):
            node = {"text": [], "attrs": dict(attrs)}
            if self.open and "row" in self.open[-1][1]:  # a direct child only
                self.open[-1][1]["row"].append(node)
        self.open.append((tag, node))

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        for _, node in self.open:
            if "text" in node:
                node["text"].append(data)


def _span(cell: dict, name: str) -> int:
    try:
        return max(1, int(cell["attrs"].get(name) or 1))
    except ValueError:
        return 1


def html_grid(fragment: str) -> Grid | None:
    """A dense grid of cell texts: spans are filled in, short rows padded."""
    parser = _Rows()
    parser.feed(fragment)
    parser.close()
    taken: dict[tuple[int, int], str] = {}
    grid: Grid = []
    for r, cells in enumerate(parser.rows):
        c = 0
        for cell in cells:
            while (r, c) in taken:
                c += 1
            text, wide, tall = " ".join("".join(cell["text"]).split()), _span(cell, "colspan"), _span(cell, "rowspan")
            taken.update({(y, x): text for y in range(r, r + tall) for x in range(c, c + wide)})
            c += wide
        while (r, c) in taken:  # what reaches down from above, as far as it goes on without a gap
            c += 1
        grid.append([taken[r, x] for x in range(c)])
    width = max(map(len, grid), default=0)
    return [row + [""] * (width - len(row)) for row in grid] if width else None


def cell_of(value: object) -> str:
    return "" if value is None else str(value).replace("\n", " ").strip()


def _unique(names: list[str]) -> list[str]:
    count: dict[str, int] = {}
    out = []
    for name in names:
        base = name or "Column"
        count[base] = count.get(base, 0) + 1
        out.append(base if count[base] == 1 else f"{base}_{count[base]}")
    return out


def grid_table(header: list, rows: list) -> Table | None:
    """A table from a header and rows of any widths; without rows a header alone."""
    body = [r for r in rows if isinstance(r, list)] if isinstance(rows, list) else []
    width = max([len(header), *map(len, body)]) if rows else len(header)
    if not width or not rows and not header:
        return None
    names = [cell_of(header[i]) if i < len(header) else "" for i in range(width)]
    names = _unique([n or f"Column_{i + 1}" for i, n in enumerate(names)])
    if not body and not header:
        return None
    return names, [([cell_of(c) for c in r] + [""] * width)[:width] for r in body]


def html_tables(text: str) -> list[Table]:
    grids = [html_grid(m) for m in FRAGMENT.findall(text)]
    return [t for g in grids if g and (t := grid_table(g[0], g[1:]))]


def html_table(html: str | None) -> Table | None:
    """One table from one HTML string, which may lack its table element."""
    text = (html or "").strip()
    if not text:
        return None
    grid = html_grid(text if "<table" in text.lower() else f"<table>{text}</table>")
    return grid_table(grid[0], grid[1:]) if grid else None


def json_payload(text: str):
    """What the response holds between its outermost brackets, or else braces; None if neither is JSON."""
    fence = FENCE.search(text)
    body = fence[1] if fence else text
    lo, hi = body.find("["), body.rfind("]")
    tries = [body[lo : hi + 1] if 0 <= lo < hi else body]
    lo, hi = body.find("{"), body.rfind("}")
    if 0 <= lo < hi:
        tries.append(body[lo : hi + 1])
    for attempt in tries:
        try:
            return json.loads(attempt)
        except ValueError:
            continue
    return None


def _is_grid_object(x: object) -> bool:
    return isinstance(x, dict) and ("rows" in x or "headers" in x)


def payload_tables(data) -> list[Table]:
    """{tables: [...]}, {headers, rows}, a list of those, a list of rows, or a list of row objects."""
    if isinstance(data, dict) and "tables" in data:
        return [t for item in data["tables"] for t in payload_tables(item)]
    if _is_grid_object(data):
        t = grid_table(list(data.get("headers") or []), list(data.get("rows") or []))
        return [t] if t else []
    if not isinstance(data, list) or not data:
        return []
    if all(map(_is_grid_object, data)):
        return [t for item in data for t in payload_tables(item)]
    if all(isinstance(x, list) for x in data):
        t = grid_table(data[0], data[1:])
        return [t] if t else []
    if all(isinstance(x, dict) for x in data):
        names = list(dict.fromkeys(k for x in data for k in x))
        return [([str(n) for n in names], [["" if x.get(n) is None else str(x[n]) for n in names] for x in data])] if names else []
    return []


def response_tables(text: str | None) -> list[Table]:
    return html_tables(text or "") or payload_tables(json_payload(text or ""))


_ARROW = pa.list_(pa.struct([("header", pa.list_(pa.string())), ("rows", pa.list_(pa.list_(pa.string())))]))


def as_arrow(tables: list[list[Table]]) -> pa.Array:
    return pa.array([[{"header": h, "rows": r} for h, r in own] for own in tables], _ARROW)


def _parsed(read, name: str):
    ship()

    @F.arrow_udf(f"array<{TABLE}>")
    def parse(text: pa.Array) -> pa.Array:
        return as_arrow([read(x) for x in text.to_pylist()])

    parse.__name__ = name
    return parse


def tables_of(response: Column) -> Column:
    """All tables of a response, in order; HTML first."""
    return _parsed(response_tables, "response_tables")(response)


def tables_of_html(html: Column) -> Column:
    """The table of one HTML string, as an array of one or none."""
    return _parsed(lambda x: [t] if (t := html_table(x)) else [], "html_table")(html)


def predicted_html(result: Column) -> Column:
    """A recognition result's HTML (result: JSON text): pred_html, html.pred, html as text, res.html, whichever is first filled."""
    filled = lambda path: F.nullif(F.get_json_object(result, path), F.lit(""))
    nested = F.get_json_object(result, "$.html")
    text = F.when(~nested.rlike(r"^\s*\{") & (F.trim(nested) != ""), nested)
    return F.coalesce(filled("$.pred_html"), filled("$.html.pred"), text, filled("$.res.html"))


def page_htmls(page: Column) -> Column:
    """All tables' HTML of a page result (JSON text with table_res_list), in order."""
    items = F.from_json(F.get_json_object(page, "$.table_res_list"), "array<string>")
    return F.filter(F.transform(F.coalesce(items, F.array().cast("array<string>")), predicted_html), lambda x: x.isNotNull())


def table_blocks(blocks: Column) -> Column:
    """Layout blocks (array of structs with a field type) that are tables."""
    return F.filter(blocks, lambda b: b["type"] == "table")


def with_tables(responses: DataFrame, column: str = "response") -> DataFrame:
    """(doc_id, page_no, tables): non-empty tables of each response, in order."""
    return responses.select("doc_id", "page_no", F.filter(tables_of(F.col(column)), lambda t: F.size(t["rows"]) > 0).alias("tables"))
