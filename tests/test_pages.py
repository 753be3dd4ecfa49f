"""Documents, pages and jobs with plugged-in models."""

import json

import pytest

from gridweave.operators.folds import BLOCK
from gridweave.operators.grids import grid_tables
from gridweave.plans import cli
from gridweave.plans.jobs import cascade, classic, routed
from gridweave.sources import pages, readers, writers
from gridweave.sources.backends import Backend, ExtractionError, grid_backend, model_backend
from tests.helpers import table


def _files(spark):
    return spark.createDataFrame([(1, "a.pdf", bytearray(b"good")), (2, "b.pdf", bytearray(b"bad")), (3, "c.pdf", bytearray(b"")), (4, "d.doc", bytearray(b"good")), (None, "e.pdf", bytearray(b"good"))], "doc_id long, path string, content binary")


def _convert(path, content):
    if content == b"bad":
        raise RuntimeError("broken")
    return "# " + content.decode() if content else ""


def test_failed_files_take_their_text_layer(spark):
    layer = spark.createDataFrame([(2, "layer two"), (4, "layer four")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text, r.converted) for r in pages.markdown(_files(spark), _convert, layer).collect())
    assert got == [(0, "# good", True), (1, "# good", True), (2, "layer two", False), (3, "", False), (4, "layer four", False)]
    assert sorted((r.doc_id or 0) for r in pages.markdown(_files(spark), _convert).collect()) == [0, 1]
    assert {r.text for r in pages.markdown(_files(spark), _convert, layer, skip=True).collect()} == {"", "layer two", "layer four"}
    with pytest.raises(ExtractionError):
        pages.markdown(_files(spark), _convert, skip=True)
    pages.release_memory()
    assert pages.has_device() in (False, True) and (pages.project_root() / "gridweave").exists()


def test_rendering_crops_and_falls_back(spark):
    own = spark.createDataFrame([(1, 0, bytearray(b"x")), (1, 1, bytearray(b"x")), (2, 0, bytearray(b"x"))], "doc_id long, page_no int, content binary")
    boxes = spark.createDataFrame([(1, 0, 1.0, 2.0, 3.0, 4.0), (2, 0, -1.0, 0.0, 1.0, 1.0)], "doc_id long, page_no int, x0 double, y0 double, x1 double, y1 double")

    def render(content, page, dpi, gray, box):
        if box and box[0] < 0:
            raise ValueError("outside")
        return json.dumps([page, dpi, gray, box]).encode()

    got = {(r.doc_id, r.page_no): json.loads(bytes(r.image)) for r in pages.rendered(own, render, 300, True, boxes).collect()}
    assert got == {(1, 0): [0, 300, True, [1.0, 2.0, 3.0, 4.0]], (1, 1): [1, 300, True, None], (2, 0): [0, 300, True, None]}
    assert pages.rendered(own, render).count() == 3


def test_page_analysis_survives_errors(spark):
    own = spark.createDataFrame([(1, 0, bytearray(b"ok")), (1, 1, bytearray(b"no"))], "doc_id long, page_no int, image binary")

    def engine(image):
        if image == b"no":
            raise RuntimeError
        return '[{"type": "table"}]'

    assert {r.page_no: r.page_result for r in pages.analysed(own, engine).collect()} == {0: '[{"type": "table"}]', 1: "[]"}


def test_each_backend_sees_a_page_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def infer(rows):
        calls.add(len(rows))
        return ["" for _ in rows]

    own = spark.range(100).selectExpr("id as doc_id", "0 as page_no", "0 as index_on_page", "'x' as image", "array(array('H'), array('1')) as rows")
    found = cascade(own, [model_backend(infer, f"m{k}") for k in range(3)] + [grid_backend()])
    assert found.count() == 100 and found.count() == 100 and calls.value == 300


def test_crop_pass_follows_the_whole_page(spark):
    whole = spark.createDataFrame([(1, 0, "whole"), (2, 0, "none"), (3, 0, "none")], "doc_id long, page_no int, image string")
    cropped = spark.createDataFrame([(1, 0, "whole"), (2, 0, "whole"), (3, 0, "none")], "doc_id long, page_no int, image string")
    model = model_backend(lambda rows: ["<table><tr><td>H</td></tr><tr><td>1</td></tr></table>" if r["image"] == "whole" else "" for r in rows])
    got = pages.with_crop_pass(lambda _: model, whole, cropped).collect()
    assert sorted((r.doc_id, r.backend) for r in got) == [(1, "vlm"), (2, "vlm_cropped")]


def test_ruled_lines_make_grids(spark):
    frame = [(0, 0, 100, 0), (0, 20, 100, 20), (0, 40, 100, 40), (0, 0, 0, 40), (50, 0, 50, 40), (100, 1, 100, 40.5), (100.8, 0, 100.8, 40)]
    second = [(x0, y0 + 200, x1, y1 + 200) for x0, y0, x1, y1 in frame]
    lines = spark.createDataFrame([(1, 0, *map(float, x)) for x in frame + second] + [(2, 0, 0.0, 0.0, 9.0, 0.0), (2, 0, 0.0, 0.0, 0.0, 9.0)], "doc_id long, page_no int, x0 double, y0 double, x1 double, y1 double")
    words = spark.createDataFrame([(1, 0, 5.0, 5.0, 20.0, 15.0, "H"), (1, 0, 55.0, 5.0, 70.0, 15.0, "I"), (1, 0, 25.0, 25.0, 30.0, 30.0, "two"), (1, 0, 5.0, 25.0, 20.0, 30.0, "one"), (1, 0, 5.0, 31.0, 20.0, 37.0, "under"), (1, 0, 5.0, 205.0, 9.0, 215.0, "S"), (1, 0, 300.0, 5.0, 310.0, 9.0, "out")], "doc_id long, page_no int, x0 double, y0 double, x1 double, y1 double, text string")
    got = sorted((r.doc_id, r.index_on_page, r.rows) for r in pages.ruled_tables(lines, words).collect())
    assert got == [(1, 0, [["H", "I"], ["one two\nunder", None]]), (1, 1, [["S", None], [None, None]])]
    assert grid_tables(pages.ruled_tables(lines, words)).count() == 2
    assert pages.ruled_tables(lines.where("false"), words).count() == 0


def test_only_documents_with_table_pages_are_extracted(spark):
    docs = spark.createDataFrame([(1, "Prose."), (2, "| A | B |\n|---|---|\n| 1 | one |")], "doc_id long, text string")
    flagged = spark.createDataFrame([(2, 0)], "doc_id long, page_no int")
    asked = []

    def tables(own):
        asked.extend(r.doc_id for r in own.collect())
        return spark.createDataFrame([(2, "grid", 0, (["A", "B"], [["1", "uno"]]))], "doc_id long, backend string, table_no int, table struct<header: array<string>, rows: array<array<string>>>")

    got = {r.doc_id: (r.backend, r.text) for r in routed(docs, flagged, tables, []).collect()}
    assert asked == [2] and got[1] == ("none", "Prose.\n") and got[2][0] == "grid" and "uno" in got[2][1]


def test_word_files_and_exports(spark, tmp_path):
    kind = "array<struct<header: array<string>, rows: array<array<string>>>>"
    docs = spark.createDataFrame([(1, "one\ntwo", [table(["A"], ["x"])], "# m"), (2, "", [], None)], f"doc_id long, text string, tables {kind}, markdown string")
    names = {(r.doc_id, r.name) for r in writers.text_then_tables(docs).collect()}
    assert names == {(1, "output.docx"), (2, "output.docx")}
    paths = writers.export_tables(docs, str(tmp_path), markdown=False)
    assert sorted(p.relative_to(tmp_path).as_posix() for p in paths) == ["1/output_tables.xlsx", "1/output_tables_table_1.csv", "2/output_tables.xlsx", "2/output_tables_empty.csv"]
    assert sorted(bytes(r.content) for r in writers.markdown_files(docs).collect()) == [b"", b"# m"]
    files, shown = writers.word_documents_of_markdown(docs.select("doc_id", "text"), docs.select("doc_id").selectExpr("doc_id", "0 as table_no", "cast(null as struct<header: array<string>, rows: array<array<string>>>) as table").where("false"), [("one", "ONE")])
    assert files.count() == 2 and {len(r.tables) for r in shown.collect()} == {0}
    assert classic(docs.select("doc_id", "text")).columns == ["doc_id", "tables", "text", "markdown", "table_count"]
    assert BLOCK.startswith("struct<")


def test_command_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("Prose.\n\n| No | Text |\n|---|---|\n| 1 | some words |\n")
    assert cli.main(["classic", "-i", str(tmp_path / "in"), "-o", str(tmp_path / "one")], spark) == 0
    assert {p.name for p in (tmp_path / "one").rglob("*.*")} == {"output.txt", "output_tables.xlsx", "output_tables_table_1.csv", "output_markdown.md"}
    assert cli.main(["classic", "--no-markdown", "-i", str(tmp_path / "in"), "-o", str(tmp_path / "two")], spark) == 0
    assert not list((tmp_path / "two").rglob("*.md"))
    key = readers.texts(spark, str(tmp_path / "in")).first().doc_id
    (tmp_path / "g.json").write_text(json.dumps({"doc_id": key, "page_no": 0, "index_on_page": 0, "rows": [["No", "Text"], ["1", "better words"]]}))
    (tmp_path / "a.json").write_text(json.dumps({"doc_id": key, "page_no": 0, "response": "nothing"}))
    assert cli.route_and_extract(spark, str(tmp_path / "in"), str(tmp_path / "three"), grids=str(tmp_path / "g.json"), docx=True) == 0
    assert "better words" in next((tmp_path / "three").rglob("output.txt")).read_text()
    assert cli.main(["-i", str(tmp_path / "in"), "-o", str(tmp_path / "four"), "--answers", str(tmp_path / "a.json")], spark) == 2
    assert cli.main(["grids", "--debug-tables", "-i", str(tmp_path / "g.json"), "-o", str(tmp_path / "five")], spark) == 0 and len(list((tmp_path / "five").rglob("*.csv"))) == 1
    assert cli.main(["-i", str(tmp_path / "missing"), "-o", str(tmp_path / "six")], spark) == 1
    a = cli.arguments(["-i", "x", "--skip-marker", "--vlm-model", "8B"])
    assert (a.command, a.skip_marker, a.force_marker, a.vlm_model) == ("smart", True, None, "8B")
    nothing = Backend("none", lambda p: grid_backend().extract(p).where("false"))
    assert cascade(spark.range(1).selectExpr("id as doc_id", "0 as page_no", "0 as index_on_page", "array(array('a')) as rows"), [nothing]).count() == 0
