"""The pipeline's stages, each against its own brute force, and all together."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from gridweave.llm import base, queries, toxicity, words
from tests.llm import brute


def rows_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = dict(pipeline.STAGES)
    one = steps["toxicity"](spark, docs, sf)
    net = toxicity.trained(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    flagged = {r.doc_id for r in toxicity.score(docs, net).where("flagged").collect()}
    assert one.columns == docs.columns and set(rows_of(one)) == set(rows_of(docs)) - flagged
    two = steps["line dedup"](spark, docs, sf)
    want = {i: t for i, t in brute.kept_lines(list(rows_of(docs).items())).items()}
    got = rows_of(two)
    assert two.columns == docs.columns and all(got[i] == want[i] for i in got) and all(not brute.SPACED.search(want[i]) for i in set(want) - set(got))
    assert two.where(F.length("text") != F.col("n_chars")).count() == docs.where(F.length("text") != F.col("n_chars")).count()
    three = steps["near-dedup"](spark, docs, sf)
    u = brute.linked({i: brute.shingles(t, 5) for i, t in rows_of(docs).items()})
    assert three.columns == docs.columns and set(rows_of(three)) == {i for i in rows_of(docs) if u.find(i) == i}
    four = steps["decontamination"](spark, docs, sf)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert four.columns == docs.columns and set(rows_of(four)) == {i for i, t in rows_of(docs).items() if not brute.contaminated(t, items)[1]}


def test_stages_of_odd_rows(spark, sf, odd, frame):
    docs = frame([(i, t, None, None, None, 1) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long, node int")
    for own in (docs, docs.where("false")):
        for name, stage in pipeline.STAGES[:-1]:
            assert stage(spark, own, sf).columns == docs.columns, name
        pipeline.STAGES[-1][1](spark, own, sf).count()
    left = [(r.doc_id, r.text) for r in pipeline.drop_near_duplicates(spark, docs, sf).collect()]
    assert len(left) == len(set(left)) == len({(i, t) for i, t in odd}) - 1  # one of the two copies of row 5, and 5 itself as a copy of 4


def test_one_near_copy_stays_whatever_the_ids(spark, sf, frame):
    text = " ".join(f"word{k}" for k in range(60))
    rows = [(None, text), (None, text + " more"), (None, "another text " * 9), (5, "the " + text.upper()), (None, None), (None, "")]
    for own, left in ((rows, 4), (rows[:3], 2)):
        docs = frame([(i, t, None) for i, t in own], "doc_id long, text string, first string")
        got = pipeline.drop_near_duplicates(spark, docs, sf).collect()
        assert len(got) == left and sum(text in (r.text or "").lower() for r in got) == 1


def test_whole_pipeline(spark, sf):
    got = pipeline.run(spark, sf).collect()
    assert got and {len(np.frombuffer(bytes(r.ids), "<u4")) == r.length for r in got} == {True}


def test_workers_get_texts_in_small_batches(spark, sf, frame):
    sizes = lambda: [r.n for r in frame([(i, "a word " * 150_000) for i in range(24)], parts=1).mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()]
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(20)
    spark.conf.unset(base.BATCH_BYTES)  # other tests call stages, which leave it set
    pipeline.run(spark, sf)
    assert max(sizes()) > 2 * base.SMALL  # run() takes its setting back
    for name, stage in pipeline.STAGES:
        try:
            stage(spark, docs, sf)
            assert base.SMALL / 2 < max(sizes()) < 1.5 * base.SMALL, name
        finally:
            spark.conf.unset(base.BATCH_BYTES)
    spark.conf.set(base.BATCH_BYTES, 4 << 20)
    try:
        pipeline.pack(spark, docs, sf)
        assert int(spark.conf.get(base.BATCH_BYTES)) == 4 << 20  # the session's own size stays
    finally:
        spark.conf.unset(base.BATCH_BYTES)


def test_trimmed_workers_keep_no_tables():
    text = pa.array(["some words " * 1000])
    before = [w.hashes for _, _, w in words.scan_column(text, words.SPACED)]
    base.trim()
    assert sum(x.nbytes for x in words._powers) < 100
    assert all((a == w.hashes).all() for a, (_, _, w) in zip(before, words.scan_column(text, words.SPACED), strict=True))


def test_queries_return_the_contracts_columns(spark, sf):
    want = {1: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", 2: "doc_id n_words n_removed kept_sha256", 3: "doc_id n_assign n_access n_hex base_sha256 spans", 4: "doc_id start length ids_crc32 doc_tokens sequence_id offset", 5: "doc_id size text_crc32 law shard slot grown_shard", 6: "doc_id n_shingles component_id kept", 7: "doc_id held_out score predicted", 9: "doc_id held_out n_tokens n_known train_tokens base_score score", 10: "doc_id n_words n_hit n_items items_sha256 contaminated"}
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name, f in queries.queries().items():
        number = int(name[2:].split("_")[0])
        df = f(spark, sf)
        assert set(want.get(number, "doc_id").split()) <= set(df.columns), name
        assert number == 4 or df.count() == n, name
