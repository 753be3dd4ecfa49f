"""Tables as literals and expressions evaluated on them."""

from pyspark.sql import functions as F

from gridweave.functions.base import TABLE


def table(header, *rows):
    return {"header": list(header), "rows": [list(r) for r in rows]}


def plain(value):
    if hasattr(value, "asDict"):
        return {k: plain(v) for k, v in value.asDict().items()}
    return [plain(v) for v in value] if isinstance(value, list) else value


def on_table(spark, t, expression):
    """expression(column) over one table."""
    return plain(spark.createDataFrame([(t,)], f"t {TABLE}").select(expression(F.col("t")).alias("x")).first().x)


def on_tables(spark, ts, expression):
    return plain(spark.createDataFrame([(ts,)], f"t array<{TABLE}>").select(expression(F.col("t")).alias("x")).first().x)


def on_text(spark, text, expression):
    return plain(spark.createDataFrame([(text,)], "t string").select(expression(F.col("t")).alias("x")).first().x)
