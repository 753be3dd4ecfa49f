import pytest
from pyspark.sql import functions as F

from gridweave.functions import predicates as P
from gridweave.operators import markdown
from tests.helpers import on_text, plain

TWO = "# Heading\n\nProse with a lone | pipe.\n\n| Name | Age |\n|---|---|\n| Alice | 30 |\n| Bob | 25 |\n\nMiddle prose.\n\n| A | B | C |\n| ---: | :---: | --- |\n| 1 | 2 | 3 |\n\nEnd."


def blocks(spark, text):
    return [plain(r) for r in markdown.blocks(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("block_no").collect()]


def test_separators(spark):
    for line, want in [("|---|---|", True), ("| --- | :---: | ---: |", True), ("---|---", True), ("| Name | Age |", False), ("just text", False), ("| - |", False), ("|---|", False)]:
        assert on_text(spark, line, P.is_separator) is want, line


def test_order_and_cells(spark):
    got = blocks(spark, TWO)
    assert [b["kind"] for b in got] == ["text", "table", "text", "table", "text"]
    assert got[1]["table"] == {"header": ["Name", "Age"], "rows": [["Alice", "30"], ["Bob", "25"]]}
    assert got[3]["table"]["header"] == ["A", "B", "C"]
    assert got[0]["text"] == "# Heading\n\nProse with a lone | pipe."


@pytest.mark.parametrize("text", ["Price | notes without separator", "", "\n\n", "| only | header |\n|---|---|"])
def test_no_table(spark, text):
    got = blocks(spark, text)
    assert all(b["kind"] == "text" for b in got)
    assert "\n".join(b["text"] for b in got) == text.rstrip()


def test_lone_table(spark):
    got = blocks(spark, "| A | B |\n|---|---|\n| longer | text |")
    assert len(got) == 1 and got[0]["table"]["rows"] == [["longer", "text"]]


def test_failed_table_joins_the_text_behind(spark):
    got = blocks(spark, "before\n| A | B |\n|---|---|\n\nbehind")
    assert [b["text"] for b in got] == ["before", "| A | B |\n|---|---|\n\nbehind"]


def test_headerless_continuation(spark):
    got = blocks(spark, "| 1.3.2 | Thu tài sản khẩn cấp tạm thời | | |\n|---|---|---|---|\n| 2 | Another long text | | |")
    assert got[0]["table"]["header"] == ["col", "col_1", "col_2", "col_3"]
    assert got[0]["table"]["rows"][0][:2] == ["1.3.2", "Thu tài sản khẩn cấp tạm thời"] and len(got[0]["table"]["rows"]) == 2


def test_noise_rows_and_subheaders(spark):
    got = blocks(spark, "| Số | Nội dung | Tiền |\n|---|---|---|\n| A | B | C |\n| 1 | Thu án phí | 10.000 |")
    assert got[0]["table"]["rows"] == [["1", "Thu án phí", "10.000"]]
    got = blocks(spark, "| A | | | | Sum |\n|---|---|---|---|---|\n| | | | Left | Right |\n| 1 | some text | x | 10 | 20 |")
    assert got[0]["table"]["header"] == ["A", "col_1", "col_2", "Left", "Sum Right"]


def test_small_numbers_are_lost_as_noise(spark):
    assert blocks(spark, "| A | B | C | D |\n|---|---|---|---|\n| 10 | 20 | 30 | 40 |\n| 1 | text that counts | 3 | 4 |")[0]["table"]["rows"] == [["1", "text that counts", "3", "4"]]


def test_ragged_rows_and_duplicate_names(spark):
    got = blocks(spark, "A | A | A\n---|---|---\nonly one | two\nlong cell | b | c | d")
    assert got[0]["table"]["header"] == ["A", "A_1", "A_2", "col_3"]
    assert got[0]["table"]["rows"][-1] == ["long cell", "b", "c", "d"]


def test_separator_first(spark):
    got = blocks(spark, "|---|---|\n| long text one | long text two |")
    assert got[0]["kind"] == "text"


def test_two_separators_in_one_run(spark):
    got = blocks(spark, "| Name | Town |\n|---|---|\n| Alice | Hanoi |\n| Next | Head |\n|---|---|\n| Bob | Hue |")
    assert len(got) == 1 and [r[0] for r in got[0]["table"]["rows"]] == ["Alice", "Next", "Bob"]


def test_cells_and_parsed(spark):
    docs = spark.createDataFrame([(1, TWO), (2, ""), (3, None)], "doc_id long, text string")
    cells = markdown.cells(markdown.blocks(docs).where("kind = 'table'"), "doc_id", "block_no")
    assert cells.where("row_no = -1").count() == 5 and cells.count() == 12
    rows = {r.doc_id: r for r in markdown.parsed(docs).collect()}
    assert len(rows[1].tables) == 2 and rows[1].text.endswith("End.\n") and rows[2].text == "" and rows[3].tables == []


def test_same_blocks_after_repartition(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit(TWO).alias("text"))
    assert markdown.blocks(docs.repartition(7)).groupBy("kind").count().orderBy("kind").collect() == markdown.blocks(docs.coalesce(1)).groupBy("kind").count().orderBy("kind").collect()
