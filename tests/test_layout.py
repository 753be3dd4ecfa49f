from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridweave.functions.base import TABLE
from gridweave.functions.layout import absorb_header_rows, compact_header, demote_false_header, realign_rows, repair, split_multi_value
from gridweave.operators import folds
from gridweave.operators.folds import fold_tables
from tests.helpers import on_table, on_tables, plain, table


def test_leaked_amount(spark):
    got = on_table(spark, table("ABCDE", ["431.500", "4.2.7", "Fee by order of a court", "", ""]), realign_rows)
    assert got["rows"] == [["4.2.7", "Fee by order of a court", "431.500", "", ""]]


def test_two_columns_lose_the_amount(spark):
    assert on_table(spark, table("AB", ["431.500", "4.2.7"], ["1.1", "2"]), realign_rows)["rows"] == [["4.2.7", ""], ["2", ""]]


def test_late_row(spark):
    assert on_table(spark, table("ABCDE", ["", "4.2.8", "arrears", "", "5"]), realign_rows)["rows"] == [["4.2.8", "arrears", "", "5", ""]]


def test_false_header(spark):
    got = on_table(spark, table(["6.1.5", "Goods held for a week", "Column_3", "Column_4"], ["2", "x", "y", "z"]), demote_false_header)
    assert got["header"] == ["Column_1", "Column_2", "Column_3", "Column_4"] and got["rows"][0] == ["6.1.5", "Goods held for a week", "", ""] and len(got["rows"]) == 2


def test_compact(spark):
    assert on_table(spark, table(["", "", "line no", "subject"], "abcd"), compact_header)["header"] == ["line no", "subject", "", ""]
    assert on_table(spark, table(["", "one"], "ab"), compact_header)["header"] == ["", "one"]


def test_absorb(spark):
    t = table(["", "", "line no", "subject", "", "", "", ""], ["", "handed on", "", "sent back", "on hold", "", "", ""], ["A", "B", "1", "2", "3", "4", "5", "6"], ["I", "all of it", "1", "", "", "", "", ""])
    got = on_table(spark, t, absorb_header_rows)
    assert got["rows"][0][0] == "I" and len(got["rows"]) == 1
    assert got["header"] == ["line no A", "subject B", "handed on 1", "sent back 2", "on hold 3", "4", "5", "6"]


def test_text_bodies_are_taken_for_labels(spark):
    assert on_table(spark, table(["Name", "City"], ["Maren", "Lund"], ["Otto", "Graz"]), repair)["rows"] == []


def test_integer_row_becomes_names(spark):
    got = on_table(spark, table("ABC", ["1", "2", "3"], ["1.1", "text", "x"]), repair)
    assert got["header"] == ["A 1", "B 2", "C 3"]


def test_split(spark):
    got = on_table(spark, table(["No", "Due", "Due_2"], ["1", "4.150.000   3.975.500", "x"], ["2", "5", "1 2 3"]), split_multi_value)
    assert got["header"] == ["No", "Due", "Due_2", "Due_2", "Due_2_2", "Due_2_3"]
    assert got["rows"] == [["1", "4.150.000", "3.975.500", "x", "", ""], ["2", "5", "", "1", "2", "3"]]


def test_split_keeps_text(spark):
    got = on_table(spark, table("A", ["a<br>b  c"]), split_multi_value)
    assert got == {"header": ["A"], "rows": [["a b c"]]}


def test_outline_stitching(spark):
    one = table(["", "", "line no", "subject"], ["", "handed on", "", "sent back"], ["A", "B", "1", "2"], ["6.1.4", "taken back", "5", "6"])
    two = table(["6.1.5", "Goods held for a week", "Column_3", "Column_4"], ["7", "everything", "7", "8"])
    got = on_tables(spark, [one, two], lambda t: fold_tables(t, folds.stitch_outline))
    assert len(got) == 1 and [r[0] for r in got[0]["rows"]] == ["6.1.4", "6.1.5", "7"]


def test_no_stitching(spark):
    assert len(on_tables(spark, [table(["Code", "Name"], ["1", "long text"]), table(["City", "Zip"], ["9", "other text"])], lambda t: fold_tables(t, folds.stitch_outline))) == 2
    back = on_tables(spark, [table(["No", "Text", "Sum"], ["II", "abc def", "x"]), table(["Column_1", "Column_2", "Column_3"], ["1", "abc def", "x"])], lambda t: fold_tables(t, folds.stitch_outline))
    assert len(back) == 2  # letters come behind all numbers
    assert len(on_tables(spark, [], lambda t: fold_tables(t, folds.stitch_outline))) == 0
    lone = table(["Name", "City"], ["Maren", "Lund"])
    assert on_tables(spark, [lone], lambda t: fold_tables(t, folds.stitch_outline)) == [lone]


def test_fold_compares_with_what_is_joined(spark):
    page = lambda code: table(["Column_1", "Column_2", "Column_3"], [code, "long text", "x"])
    assert [len(t["rows"]) for t in on_tables(spark, [page("1"), page("3"), page("2"), page("4")], lambda t: fold_tables(t, folds.stitch_outline))] == [2, 2]


def test_model_stitching(spark):
    a, b = table(["No", "Name"], ["1", "x"]), table(["No", "Name"], ["2", "y"])
    assert [len(t["rows"]) for t in on_tables(spark, [a, b], lambda t: fold_tables(t, folds.stitch_responses))] == [2]
    assert len(on_tables(spark, [a, table(["Column_1", "Column_2"], ["2", "y"])], lambda t: fold_tables(t, folds.stitch_responses))) == 1
    assert len(on_tables(spark, [a, table(["City", "Zip"], ["Graz", "9"])], lambda t: fold_tables(t, folds.stitch_responses))) == 2
    assert len(on_tables(spark, [a, table(["No", "Name", "Sum"], ["2", "y", "z"])], lambda t: fold_tables(t, folds.stitch_responses))) == 2


def test_codes():
    rows = [["1.2", "a"], ["", "1.3"], ["word", "y"]]
    assert folds._row_codes(rows) == ["1.2", "1.3"] and not folds.continues((["1.1", "first"], rows), (["1.1", "first"], rows))
    assert folds.outline_key("1.10") > folds.outline_key("1.9") and folds.outline_key("IX") < folds.outline_key("V") and folds.outline_key("2") < folds.outline_key("I")


CELLS = st.sampled_from(["", "", "1.1", "2", "431.500", "IV", "Column_2", "col", "A", "B", "label", "some text", "12", "1,5 2,5", "a<br>b", " x  y "])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(1, 5).flatmap(lambda n: st.tuples(st.lists(CELLS, min_size=n, max_size=n), st.lists(st.lists(CELLS, min_size=n, max_size=n), max_size=4))), min_size=20, max_size=40))
def test_expressions_and_folds_agree(spark, tables):
    frame = spark.createDataFrame([(k, table(h, *rows)) for k, (h, rows) in enumerate(tables)], f"k int, t {TABLE}").coalesce(1)
    t = F.col("t")
    got = frame.select("k", *[plain_rule(t).alias(name) for name, plain_rule in EXPRESSIONS.items()]).collect()
    for row in got:
        for name, rule in (("demote", folds.demote), ("compact", folds.compact), ("absorb", folds.absorb), ("realign", folds.realign), ("split", folds.split_values)):
            x = plain(row[name])
            assert (x["header"], x["rows"]) == tuple(rule(tables[row.k])), (name, tables[row.k])


EXPRESSIONS = {"demote": demote_false_header, "compact": compact_header, "absorb": absorb_header_rows, "realign": realign_rows, "split": split_multi_value}
