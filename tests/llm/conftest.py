import pytest

from gridweave.llm.base import ship


@pytest.fixture(scope="session")
def frame(spark):
    ship(spark)

    def make(rows, schema="doc_id long, text string", parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


#: Nulls, blanks, ties, repeated rows, one long text.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "null id with some words in it"), (None, None), (6, "longer " * 5000), (7, "Ünïcode wörds, and 日本語 " * 9)]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
