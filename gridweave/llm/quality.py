"""Quality rules with adaptive thresholds.

Each document gets five ratios: symbols, lines that repeat, words in repeated 3-word windows, characters a word, capital
letters. Fixed cutoffs on such ratios fail between languages and sources, so the bounds come from the data: a mergeable
quantile sketch for each (language, source) gives the quartiles, and a document stays if no ratio lies beyond
q75 + reach * max(q75 - q25, the ratio's least spread), nor, for characters a word, below the same distance under q25.

The sketch is a histogram over logarithmic buckets (relative error 1 %): a bucket's count is a sum, so partial sketches of
any tasks merge exactly, in any order, and the result doesn't depend on how rows are dealt out. A group of fewer than
`least` documents takes its language's sketch, and a small language the sketch of all; both are merged from the same counts.

Sketches cover the documents that pass the base rules (all of them, no sample). The measures are kept in the shared
checkpoint folder, so texts are read once.

Odd input: a null or empty text has no words and fails the base rules; null language or source is a group of its own;
repeated rows and ids are judged row by row; ties don't matter; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import cut, ship

SYMBOLS = "#*$%&|<>"
#: The white space of words, as bytes.split() has it too.
SPACE = " \t\n\r\v\f"

#: name -> (expression over the measures, least spread, is there a lower bound)
RATIOS = {
    "symbols": ("n_symbols / n_words", 0.05, False),
    "dup_lines": ("n_dup_lines / n_lines", 0.11, False),
    "repeats": ("n_repeat_words / n_words", 0.10, False),
    "word_chars": ("word_chars / n_words", 0.5, True),
    "capitals": ("n_capitals / n_chars", 0.05, False),
}
#: Quartile ranges beyond the quartile.
REACH = 3.0
#: Documents that a group's own sketch needs.
LEAST = 200
#: Buckets of the sketch are [GAMMA**(i-1), GAMMA**i); 0 has its own.
GAMMA = 1.02

MEASURES = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_capitals long, n_chars long"


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that are found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(seen := set(windows)) == len(windows):
        return 0
    number = dict.fromkeys(seen, 0)
    for x in windows:
        number[x] += 1
    hit = np.array([number[x] > 1 for x in windows])
    cover = np.zeros(len(words), bool)
    for j in range(3):
        cover[j : j + len(hit)] |= hit
    return int(cover.sum())


def measure(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, n_chars."""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    capitals = sum(map(str.isupper, text)) if not text.isascii() else len(text) - len(text.translate(_NO_CAPITALS))
    return len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words), len(lines), capitals, len(text)


_NO_CAPITALS = dict.fromkeys(range(0x41, 0x5B))


def _measured(batches):
    for b in batches:
        rows = [measure(x or "") for x in b.column("text").to_pylist()]
        columns = [pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else [[]] * 8)]
        yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("doc_id", "lang", "source")), *columns], [x.split()[0] for x in MEASURES.split(", ")])


def measures(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string")).mapInArrow(_measured, MEASURES)


def with_base(measured: DataFrame) -> DataFrame:
    return measured.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))


def sketches(passed: DataFrame) -> DataFrame:
    """(level, lang, source, ratio, bucket, n): counts for each source (level 0), language (1) and all (2)."""
    long = passed.select("lang", "source", F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), F.expr(e).alias("x")) for k, (e, _, _) in RATIOS.items()])).alias("v")).select("lang", "source", "v.ratio", F.when(F.col("v.x") > 0, F.ceil(F.log(F.col("v.x")) / np.log(GAMMA))).alias("bucket"))
    own = long.groupBy("lang", "source", "ratio", "bucket").agg(F.count("*").alias("n")).withColumn("level", F.lit(0))
    by_lang = own.groupBy("lang", "ratio", "bucket").agg(F.sum("n").alias("n")).withColumns({"source": F.lit(None).cast("string"), "level": F.lit(1)})
    return own.unionByName(by_lang).unionByName(by_lang.groupBy("ratio", "bucket").agg(F.sum("n").alias("n")).withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "level": F.lit(2)}))


def bounds(sketch: DataFrame) -> DataFrame:
    """(level, lang, source, ratio, number, low, high) from the sketches; a bucket stands for its upper end."""
    group = Window.partitionBy("level", "lang", "source", "ratio")
    run = sketch.withColumns({"upto": F.sum("n").over(group.orderBy(F.col("bucket").asc_nulls_first())), "number": F.sum("n").over(group), "x": F.coalesce(F.pow(F.lit(GAMMA), F.col("bucket")), F.lit(0.0))})
    quartiles = run.groupBy("level", "lang", "source", "ratio").agg(F.first("number").alias("number"), *[F.min(F.when(F.col("upto") >= F.col("number") * q, F.col("x"))).alias(k) for k, q in (("q25", 0.25), ("q75", 0.75))])
    spread = F.create_map(*[F.lit(x) for k, (_, s, _) in RATIOS.items() for x in (k, s)])
    low = F.create_map(*[F.lit(x) for k, (_, _, b) in RATIOS.items() for x in (k, b)])
    reach = F.lit(REACH) * F.greatest(F.col("q75") - F.col("q25"), spread[F.col("ratio")])
    return quartiles.select("level", "lang", "source", "ratio", "number", F.when(low[F.col("ratio")], F.col("q25") - reach).alias("low"), (F.col("q75") + reach).alias("high"))


def thresholds(measured: DataFrame) -> DataFrame:
    """One row for each (lang, source) found: bounds, a map from ratio to (low, high), of the first level that is large enough."""
    b = bounds(sketches(measured.where("not base_failed")))
    rows = b.groupBy("level", "lang", "source").agg(F.max("number").alias("number"), F.map_from_entries(F.collect_list(F.struct("ratio", F.struct("low", "high")))).alias("bounds"))
    own, by_lang, total = (rows.where(F.col("level") == k) for k in range(3))
    groups = measured.select("lang", "source").distinct()
    own = own.select(F.col("lang").alias("l0"), F.col("source").alias("s0"), F.col("number").alias("n0"), F.col("bounds").alias("b0"))
    by_lang = by_lang.select(F.col("lang").alias("l1"), F.col("number").alias("n1"), F.col("bounds").alias("b1"))
    joined = groups.join(own, F.col("lang").eqNullSafe(F.col("l0")) & F.col("source").eqNullSafe(F.col("s0")), "left").join(by_lang, F.col("lang").eqNullSafe(F.col("l1")), "left")
    joined = joined.join(F.broadcast(total.select(F.col("bounds").alias("b2"))), F.lit(True), "left")  # one row at most
    return joined.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), F.when(F.col("n0") >= LEAST, F.col("b0")).when(F.col("n1") >= LEAST, F.col("b1")).otherwise(F.col("b2")).alias("bounds"))


def quality(docs: DataFrame) -> DataFrame:
    """Each document's measures, base_failed, kept and the ratio that first broke a bound (reason)."""
    measured = cut(with_base(measures(docs)))
    limits = thresholds(measured)
    judged = measured.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    broken = [F.when(~F.coalesce(F.expr(e).between(F.coalesce(F.col("bounds")[k]["low"], F.lit(float("-inf"))), F.col("bounds")[k]["high"]), F.lit(True)), F.lit(k)) for k, (e, _, _) in RATIOS.items()]
    reason = F.when(F.col("base_failed"), F.lit("base")).otherwise(F.coalesce(*broken))
    return judged.withColumn("reason", reason).withColumn("kept", F.col("reason").isNull()).drop("t_lang", "t_source", "bounds")
