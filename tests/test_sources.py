import json

from pyspark.sql import functions as F

from gridweave.functions.cleanup import corrected, corrected_table, fixes, load_corrections
from gridweave.functions.corrections import CORRECTIONS
from gridweave.functions.names import grid_names
from gridweave.operators import geometry, prose
from gridweave.operators.responses import html_grid, html_table, json_payload, payload_tables, predicted_html, response_tables
from gridweave.plans import cli
from gridweave.plans.jobs import cascade, exit_code, stitched
from gridweave.sources import readers, writers
from gridweave.sources.backends import Backend, grid_backend, model_backend, skips_model
from gridweave.streaming import landing
from tests.helpers import on_table, on_text, plain, table


def test_json_shapes():
    grid = {"headers": ["A", "B"], "rows": [["1", 10.5], [None, True]]}
    want = (["A", "B"], [["1", "10.5"], ["", "True"]])
    assert payload_tables([grid]) == [want] and payload_tables(grid) == [want] and payload_tables({"tables": [grid, [grid]]}) == [want, want]
    assert payload_tables([["h", "h"], ["1", "2"]]) == [(["h", "h_2"], [["1", "2"]])]
    assert payload_tables([{"a": 1, "b": "x"}, {"a": 2}]) == [(["a", "b"], [["1", "x"], ["2", ""]])]
    assert payload_tables({"x": 1}) == [] and payload_tables([]) == [] and payload_tables(None) == []
    assert json_payload('Sure:\n```json\n[["a"], ["1"]]\n```') == [["a"], ["1"]]
    assert json_payload('{"a": 1} trailing') == {"a": 1} and json_payload("nothing") is None
    assert response_tables('{"rows":[["1","2"]]}') == [(["1", "2"], [])]  # the outermost brackets are those of the row list


def test_html():
    assert html_grid("<table><tr><th>A</th><th colspan='2'>B</th></tr><tr><td rowspan=2>1<td>250.000<td></tr><tr><td>x</table>") == [["A", "B", "B"], ["1", "250.000", ""], ["1", "x", ""]]
    assert html_grid("<table><tr><td colspan='x' rowspan='9'>a b\n c</td></tr></table>") == [["a b c"]]
    assert html_grid("<table></table>") is None and html_table(" ") is None and html_table(None) is None
    assert html_table("<tr><td>10.620.000</td></tr><tr><td>250.000</td></tr>") == (["10.620.000"], [["250.000"]])
    two = response_tables("<table><tr><td>a</td></tr></table> and <TABLE><tr><td>b</td></tr><tr><td>1</td></tr></TABLE> [1]")
    assert [t[0] for t in two] == [["a"], ["b"]]


def test_predicted_html(spark):
    for result, want in [({"pred_html": "<t>"}, "<t>"), ({"html": {"pred": "p"}}, "p"), ({"html": "h"}, "h"), ({"res": {"html": "r"}}, "r"), ({"x": 1}, None), ({"pred_html": "", "html": {"pred": "q"}}, "q")]:
        assert on_text(spark, json.dumps(result), predicted_html) == want


def test_dictionary(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"ab": "c", "cc": "d"}))
    pairs = load_corrections(path)
    t = table(["ab", "x", "x"], ["abab", "ab", "ab"])
    fixed = on_table(spark, t, lambda c: corrected_table(c, pairs))
    assert fixed == table(["ab", "x", "x"], ["d", "ab", "ab"])  # names, and columns that share one, stay
    assert on_table(spark, t, lambda c: fixes(c, corrected_table(c, pairs))) == 1
    assert load_corrections(tmp_path / "none.json") == [] and on_table(spark, t, lambda c: corrected_table(c, [])) == t


def test_known_corrections_cascade(spark):
    assert len(CORRECTIONS) == 82
    assert on_text(spark, "Trong hoyết", lambda c: corrected(c, CORRECTIONS)) == "Trong quyết"  # a later pair for the whole phrase never fires
    once = on_text(spark, "nước và chỉ tr", lambda c: corrected(c, CORRECTIONS))
    assert once == "Nhà nước và chỉ tr" and on_text(spark, once, lambda c: corrected(c, CORRECTIONS)) == "Nhà Nhà nước và chỉ tr"


def test_names(spark):
    assert spark.createDataFrame([(["A", None, "A", " ", "A"],)], "h array<string>").select(grid_names(F.col("h")).alias("x")).first().x == ["A", "Column_2", "A_2", "Column_4", "A_3"]


def test_prose(spark):
    text = "Cong hoa xa hoi\n\nToa an nhan dan\nI Số phải thu 10.620.000\nrest\n\nNguyen Van Anh\nChap hanh vien"
    assert on_text(spark, text, prose.header_lines) == "Cong hoa xa hoi\n\nToa an nhan dan"
    assert on_text(spark, text, prose.finalized) == "Cong hoa xa hoi\n\nToa an nhan dan\n\nNguyen Van Anh\nChap hanh vien"
    assert on_text(spark, "1. a\nab\nsignature of x\nA", prose.clean_footer) == "signature of x"
    assert on_text(spark, "\n".join(f"line no {k}x" for k in range(40)), prose.header_lines).count("\n") == 23
    assert on_text(spark, None, prose.header_lines) == "" and on_text(spark, "  hello  ", prose.finalized) == "hello"


def test_geometry(spark):
    w, h = 200, 300
    pixels = bytearray([255]) * (w * h)
    for y in range(20, 260, 40):
        pixels[y * w : (y + 1) * w] = bytes(w)
    for x in range(10, 190, 30):
        for y in range(h):
            pixels[y * w + x] = 0
    pages = spark.createDataFrame([(1, 0, w, h, bytes(pixels)), (2, 0, w, h, bytes([255]) * (w * h))], "doc_id long, page_no int, width int, height int, pixels binary")
    profile = geometry.ink(pages)
    assert [r.doc_id for r in geometry.scanned_table_pages(profile).collect()] == [1]
    box = geometry.table_boxes(profile, pages.select("doc_id", "page_no", "width", "height")).first()
    assert 0 <= box.x0 < box.x1 <= w * 0.48 and (round(box.y0, 2), round(box.y1, 2)) == (round((20 - 9) * 0.48, 2), round((220 + 9) * 0.48, 2))
    drawn = spark.createDataFrame([(2, 3)], "doc_id long, page_no int")
    assert sorted(map(tuple, geometry.table_pages(drawn, geometry.scanned_table_pages(profile)).collect())) == [(1, 0), (2, 3)]


def test_cascade(spark):
    pages = spark.createDataFrame([(1, 0, 0, [["H"], ["1"]], "no table"), (2, 0, 0, [["H"], ["1"]], "<table><tr><td>M</td></tr><tr><td>2</td></tr></table>"), (3, 0, 0, [], "")], "doc_id long, page_no int, index_on_page int, rows array<array<string>>, image string")
    model = model_backend(lambda rows: [r["image"] for r in rows])
    got = {r.doc_id: (r.backend, r.table.rows) for r in cascade(pages, [model, grid_backend()]).collect()}
    assert got == {1: ("grid", [["1"]]), 2: ("vlm", [["2"]])}
    nothing = Backend("none", lambda p: grid_backend().extract(p).where("false"))
    assert cascade(pages, [nothing]).count() == 0
    one = stitched(cascade(pages, [grid_backend()]).drop("backend"), [("1", "one")])
    assert {r.doc_id: r.table.rows for r in one.collect()} == {1: [["one"]], 2: [["one"]]}


def test_flags():
    assert skips_model(env={}) and not skips_model(env={"FORCE_MARKER": "1"}) and not skips_model(env={"SKIP_MARKER": "no"}) and not skips_model(force=True, skip=True) and skips_model(skip=True, env={"FORCE_MARKER": "1"})


def test_workbooks(spark, tmp_path):
    docs = spark.createDataFrame([(1, [table(["A", "Column_2"], ["250.000", "<&>"]), table("B")]), (2, [])], "doc_id long, tables array<struct<header: array<string>, rows: array<array<string>>>>")
    files = writers.workbooks(docs)
    assert [n for n, _ in readers.sheets(bytes(files.where("doc_id = 1").first().content))] == ["Table_1", "Table_2"]
    back = {r.doc_id: plain(r.tables) for r in readers.workbook_tables(files).collect()}
    assert back == {1: [table(["A", "Column_2"], ["250.000", "<&>"])], 2: []}
    names = sorted(p.name for p in writers.save(writers.csv_files(docs), str(tmp_path)))
    assert names == ["output_tables_empty.csv", "output_tables_table_1.csv", "output_tables_table_2.csv"]
    assert (tmp_path / "1" / "output_tables_table_1.csv").read_bytes() == "﻿A,Column_2\n250.000,<&>\n".encode()
    assert writers.previews(docs).count() == 2
    assert writers.output_path(str(tmp_path / "x" / "r.docx")).name == "r.docx" and writers.output_path(str(tmp_path / "y")).name == "output.docx"


def test_word_document():
    data = writers.docx([{"kind": "text", "text": "one\n\ntwo", "table": None}, {"kind": "table", "text": None, "table": table(["col", "col_1"], ["", "x"])}])
    import io
    import zipfile

    body = zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml").decode()
    assert body.count("<w:tr>") == 1 and "one" in body and "col_1" not in body


def test_command_line_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("Prose.\n\n| No | Text |\n|---|---|\n| 1 | some words |\n")
    assert cli.main(["-i", str(tmp_path / "in"), "-o", str(tmp_path / "out"), "--docx"], spark) == 0
    assert len(list((tmp_path / "out").rglob("output.*"))) == 2 and next((tmp_path / "out").rglob("output.txt")).read_text().startswith("Prose.\n\n| No | Text")
    query = landing.write_blocks(landing.arriving(spark, str(tmp_path / "in")), str(tmp_path / "stream"), str(tmp_path / "state"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "stream")).count() == 2


def test_failed_documents(spark):
    rows = spark.createDataFrame([("failed",), ("grid",)], "backend string")
    assert exit_code(rows) == 2 and exit_code(rows.where("backend = 'grid'")) == 0
