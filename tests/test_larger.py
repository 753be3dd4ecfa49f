"""What fails only on larger or odder tables than the smallest ones."""

import time

from pyspark.sql import functions as F

import __spark_entry__
from gridweave.functions.base import TABLE
from gridweave.functions.names import grid_names, parser_names, response_names
from gridweave.operators import assembly
from tests.helpers import table


def test_tables_are_not_broadcast(spark):
    blocks = spark.createDataFrame([(1, 0, "table", table("AB", ["1", "2"]))], f"doc_id long, block_no int, kind string, table {TABLE}")
    found = spark.createDataFrame([(1, k, table("AB"[: k + 1])) for k in range(2)], f"doc_id long, table_no long, table {TABLE}")
    pairs = assembly.matches(blocks, found)
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert {(r.table_no, r["rank"]) for r in pairs.collect()} == {(0, 2), (1, 1)}


def plainly(names, first):
    return [x if not (k := names[:i].count(x)) else f"{x}_{k + first - 1}" for i, x in enumerate(names)]


def test_names_in_long_headers(spark):
    own = [f"n{k * k % 17}" for k in range(300)]
    mixed = ["b", "a", "", "a", "b", "a_1", "a", ""]
    rows = spark.createDataFrame([(0, own), (1, mixed), (2, []), (3, None), (4, ["a", None, "a", None])], "k int, h array<string>").orderBy("k")
    for f, blank, first in ((parser_names, "col", 1), (response_names, "Column", 2)):
        got = [r.x for r in rows.select(f(F.col("h")).alias("x")).collect()]
        assert got[:3] == [plainly([x or blank for x in h], first) for h in (own, mixed, [])]
        assert got[3] is None and got[4] == ["a", None, f"a_{first}", None]
    long = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda i: F.concat(F.lit("n"), (i % 25).cast("string"))).alias("h"))
    began = time.perf_counter()
    got = long.select(grid_names(F.col("h")).alias("x")).first().x
    assert got[:26] == [f"n{k % 25}" for k in range(1, 26)] + ["n1_2"] and len(set(got)) == 20_000
    assert time.perf_counter() - began < 15


def test_leftover_tables_keep_their_headers(spark, tmp_path):
    spark.createDataFrame([(1,), (2,), (2,)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    orders = [(10, 1, "O", "1-URGENT"), (11, 7, "F", "5-LOW"), (12, None, "F", "5-LOW")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    rows = __spark_entry__.queries()["leftover_tables"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, rows)) == [(1, 1, "Order"), (2, 2, "Left")]
