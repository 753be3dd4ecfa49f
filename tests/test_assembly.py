from pyspark.sql import functions as F

from gridweave.functions.base import TABLE
from gridweave.functions.rendering import markdown_table, plain_grid, preview
from gridweave.functions.similarity import similarity
from gridweave.operators import assembly, folds, markdown
from tests.helpers import on_table, on_tables, plain, table

ONE = "Intro prose.\n\n| Name | Age |\n|---|---|\n| 1. Alice | 30 |\n\nClosing."
TWO = "| Name | Town |\n|---|---|\n| 1 | Hue city |\n\nMiddle.\n\n| A | B | C |\n|---|---|---|\n| 1.1 | 2 yy | 3 zz |"


def parts(spark, text, tables, pairs=()):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = spark.createDataFrame([(1, k, t) for k, t in enumerate(tables)], f"doc_id long, table_no int, table {TABLE}")
    row = assembly.documents(markdown.blocks(docs), found, list(pairs)).select("parts", assembly.composed(F.col("parts")).alias("text")).first()
    return plain(row.parts), row.text


def test_extracted_replaces(spark):
    _, text = parts(spark, ONE, [table(["Name", "Age"], ["99", "88"])])
    assert "99" in text and "88" in text and "Alice" not in text and text.startswith("Intro prose.") and text.endswith("Closing.\n")


def test_own_grid_stays(spark):
    for tables in ([], [table(["Much", "wider", "table", "here"], ["9", "8", "7", "6"])]):
        _, text = parts(spark, ONE, tables)
        assert "Alice" in text and "Much" not in text


def test_shape_beats_order(spark):
    _, text = parts(spark, TWO, [table("ABC", ["1.1", "2 y", "Hue"]), table(["Name", "Town"], ["1", "Vinh city"])])
    assert text.index("Vinh city") < text.index("Middle.") < text.index("Hue")


def test_garbled_header_takes_any(spark):
    got, _ = parts(spark, "| hoyết Tình | Erở nh | col_3 |\n|---|---|---|\n| xx yy | zz ww | vv uu |", [table(["So", "Ten", "Tien", "Them"], ["1", "a b", "2", "3"])])
    assert got[0]["table"]["header"] == ["So", "Ten", "Tien", "Them"]


def test_leftovers(spark):
    spare = table(["No", "What"], ["1", "Alpha beta"])
    got, _ = parts(spark, "Only prose.", [spare, table("X")])
    assert [b["kind"] for b in got] == ["text", "table", "table"]
    got, _ = parts(spark, ONE, [table(["Lone"], ["1"])])
    assert sum(b["kind"] == "table" for b in got) == 1


def test_images_and_corrections(spark):
    _, text = parts(spark, "# Head\n![x](y.png)\nhoyết dinh", [], [("hoyết", "quyết"), ("quyết dinh", "quyết định")])
    assert text == "Head\nquyết định\n"


def test_shared_table_is_cut(spark):
    md = "| No | Text |\n|---|---|\n| 1 | aaaa |\n| 2 | bbbb |\n\nMiddle.\n\n| No | Text |\n|---|---|\n| 3 | cccc |\n| 4 | dddd |"
    tall = table(["No", "Text"], *[[str(k), f"value {k}"] for k in range(1, 11)])
    got, _ = parts(spark, md, [tall])
    rows = [[r[0] for r in b["table"]["rows"]] for b in got if b["kind"] == "table"]
    assert rows == [["1", "2"], ["3", "4"]]  # the other six are lost with the cursor


def test_plain_grid(spark):
    assert on_table(spark, table(["col", "col_1"], ["1", "value"]), plain_grid) == "| 1 | value |"
    lines = on_table(spark, table(["So", "Noi dung", "Ghi chu", "Tien"], ["1.3.2", "Thu tai san", "", "10.000"]), plain_grid).split("\n")
    assert len(lines) == 2 and lines[0].count("|") == lines[1].count("|") and len(lines[0]) == len(lines[1])
    assert on_table(spark, table(["A", "B"]), plain_grid) == ""


def test_markdown_table(spark):
    assert on_table(spark, table(["A", "B"], ["x|y", "line\nfeed"]), markdown_table) == "| A | B |\n| --- | --- |\n| x\\|y | line feed |"
    assert on_table(spark, table([]), markdown_table) == "_empty table_"
    assert on_tables(spark, [], preview) == "# Tables preview\n\n_No tables found in document._\n"
    assert "## Table 2" in on_tables(spark, [table("A", "x"), table("B", "y")], preview)


def test_round_trip(spark):
    t = table(["Name", "Amount due"], ["first row", "10.000"], ["second row", ""])
    text = on_table(spark, t, markdown_table)
    assert plain(markdown.blocks(spark.createDataFrame([(1, text)], "doc_id long, text string")).first())["table"] == t


def test_scores(spark):
    a, b, c = table("AB", ["x", "y"]), table("AB", ["x", "z"]), table("ABCD", ["x", "y", "z", "w"])
    score = lambda x, y: on_tables(spark, [x, y], lambda t: similarity(t[0], t[1]))
    assert score(a, b) > score(a, c) and abs(score(a, a) - 1) < 1e-12 and score(a, table([])) == 0


def test_merge():
    merged = folds.merge_form
    assert merged((["So", "Ten"], [["a", "b"]]), (["Column_1", "Column_2"], [["c", "d"]])) == (["So", "Ten"], [["c", "d"]])
    assert merged((["hoyết", "x"], [["a", "b"]]), (["So TT", "Noi dung"], [["c", "d"]]))[0] == ["So TT", "Noi dung"]
    assert merged((["A", "B"], [["1 2", "x"]]), (["A", "A2", "B"], [["1", "2", "x"]]))[1] == [["1", "2", "x"]]


def test_scores_agree(spark):
    pairs = [(table("AB", ["x", "y"]), table("ABC", ["x", "z", "1"], ["a b", "c", "Đ"])), (table("A"), table("A", "b", "c", "d")), (table("Z", "q"), table("Y", "r"))]
    for m, e in pairs:
        a, b = (m["header"], m["rows"]), (e["header"], e["rows"])
        assert abs(on_tables(spark, [m, e], lambda t: similarity(t[0], t[1])) - folds.score(a, b, folds.sample(a), folds.sample(b))) < 1e-12
