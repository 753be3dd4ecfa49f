"""Operators against brute force: quality, substrings, near-duplicates, lines, decontamination."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridweave.llm import components, decontaminate, lines, minhash, quality, queries, substrings, words
from tests.llm import brute

PASSAGE = " ".join(f"shared{k}" for k in range(60))


def clashing(df):
    for name in ("node", "key", "component_id", "label", "kept", "items", "bucket", "lost_id", "removed_lines", "rep"):
        df = df.withColumn(name, F.lit(1))
    return df


def planted():
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(80))) for k in range(20)]
    rows += [(100 + k, " ".join([f"a{k}b{j}" for j in range(30)] + [PASSAGE] + [f"c{k}d{j}" for j in range(30)])) for k in range(6)]
    rows += [(200 + k, " ".join(f"w3x{j}" if j != 7 * k else f"new{k}" for j in range(80))) for k in range(8)]
    return rows + [(300, rows[0][1]), (301, rows[0][1].upper())]


def test_word_hashes_block_by_block(monkeypatch):
    r = np.random.default_rng(2)
    data = np.frombuffer(b" ".join(r.bytes(int(n)).replace(b" ", b"x") for n in r.integers(1, 40, 400)), np.uint8)
    at = words.delimiters((0x20, 0x20))
    whole = words.scan(data, np.array([0, len(data)]), at)
    monkeypatch.setattr(words, "BLOCK", 50)
    parts = words.scan(data, np.array([0, len(data)]), at)
    assert (whole.hashes == parts.hashes).all() and len(set(whole.hashes.tolist())) == len({whole.word(k) for k in range(len(whole.starts))})


def test_quality(spark, frame, documents, odd):
    for rows in (documents, odd, []):
        docs = frame([(i, t, "en", None) for i, t in rows], "doc_id long, text string, lang string, source string").withColumn("n_words", F.lit("clash"))
        got = quality.quality(docs).collect()
        assert sorted(map(repr, ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got))) == sorted(map(repr, ((i, *brute.quality(t)) for i, t in rows)))
        assert all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) and not (r.base_failed and r.kept) for r in got)


def test_quality_bounds_follow_the_group(frame):
    rows = [(k, " ".join(f"w{j}{'#' * (k % 3 == 0)}q" for j in range(60 + k % 7)), "en", "calm" if k < 300 else "loud") for k in range(600)]
    rows += [(1000, "# $ % & * | < > " * 20 + " ".join(f"w{j}" for j in range(300)), "en", "calm")]
    got = {r.doc_id: r.kept for r in quality.quality(frame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert sum(got[k] for k in range(600)) == 600


def test_sketches_merge(spark, frame):
    rows = [(k, "en", "s", 100 + k, 500 + 3 * k, k % 9, 0, 0, 5, k % 4, 700, False) for k in range(900)]
    schema = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_capitals long, n_chars long, base_failed boolean"
    one = quality.bounds(quality.sketches(frame(rows, schema, 1))).orderBy("level", "ratio").collect()
    assert one == quality.bounds(quality.sketches(frame(rows, schema, 9))).orderBy("level", "ratio").collect()
    exact = sorted((500 + 3 * k) / (100 + k) for k in range(900))[674]
    chars = next(r for r in one if r.ratio == "word_chars" and r.level == 0)
    q25 = sorted((500 + 3 * k) / (100 + k) for k in range(900))[224]
    assert abs(chars.high - (exact + 3 * max(exact - q25, 0.5))) < 0.15


@pytest.mark.parametrize("bucket", [None, 2000])
def test_substrings(frame, documents, odd, bucket):
    for rows in (planted(), documents[:80], odd + planted(), []):
        got = substrings.dedup_substrings(clashing(frame(rows)), bucket_bytes=bucket).collect()
        assert sorted(map(repr, ((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept)) for r in got))) == sorted(map(repr, brute.substrings(rows)))


def test_paths_whose_edges_stand_apart_in_the_source(frame):
    w = [f"w{k}" for k in range(16)]
    rows = [(1, " ".join(w[:13] + ["between"] + w[1:14] + ["and"] + w[2:15])), (2, "x " + "\n".join(w[:15]) + " y"), (3, " ".join(w))]
    rows += [(9, " ".join(f"q{k % 20}" for k in range(60))), (10, " ".join(f"q{k % 20}" for k in range(7, 40)))]  # places that repeat within the source
    got = substrings.dedup_substrings(frame(rows)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept)) for r in got) == sorted(brute.substrings(rows))
    assert sum(r.n_removed for r in got) > 40


def test_popular_sources_are_copied(frame):
    rows = planted() + [(None, PASSAGE + f" tail {k}") for k in range(30)] + [(7, PASSAGE + f" end {k}") for k in range(30)] + [(500 + k, " ".join(f"w{k % 20}x{j}" for j in range(k, 70))) for k in range(40)]
    want = sorted(map(repr, brute.substrings(rows)))
    for size in (None, 3000):
        got = substrings.dedup_substrings(frame(rows), bucket_bytes=size, requests=2).collect()
        assert sorted(map(repr, ((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept)) for r in got))) == want


def test_spans_name_their_source(frame):
    got = {r.doc_id: r.spans for r in substrings.dedup_substrings(frame(planted())).collect()}
    assert [(s.start, s.end, s.source) for s in got[103]] == [(30, 90, 100)]


@pytest.mark.parametrize("limits", [{}, {"list_limit": 3, "group_limit": 3}])
@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(frame, documents, k, limits):
    for rows in (planted(), documents, []):
        sets = {i: brute.shingles(t, k) for i, t in rows}
        u = brute.linked(sets)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(clashing(frame(rows)), k, **limits).collect()}
        assert got == {i: (len(sets[i]), u.find(i), u.find(i) == i) for i, _ in rows}


def test_near_duplicates_of_odd_rows(frame, odd):
    got = minhash.near_duplicates(frame(odd)).collect()
    assert len(got) == len(odd)
    by = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    assert by[1, 0] == 1 and by[2, 0] == 2 and by[5, 1] == 4 and by[4, 1] == 4 and by[None, 6] is None


@pytest.mark.parametrize("limits", [{}, {"list_limit": 3, "group_limit": 3}])
def test_lines(frame, documents, limits):
    base = "It was the same long line of quite ordinary prose with number {} in it."
    rows = [(k, "\n".join([f"Own line number {k * 7919} of document {k * 104729}.", base.format(k), "short"])) for k in range(30)]
    rows += [(40, "A line of sixty characters and more, and a bit more is also here."), (41, "x\nA line of sixty characters and more, bnd a bit more is also here.")]
    rows += [(50, None), (51, ""), (52, "IT WAS  the same long line of quite ordinary prose with number 5 in it.\t\n\n"), (53, "日本語" * 20), (54, "日本語" * 20 + "x")]
    for own in (rows, documents, []):
        got = {r.doc_id: r.text for r in lines.drop_lines(clashing(frame(own)), **limits).collect()}
        assert got == brute.kept_lines(own)


def test_ranges_above_the_limit_pass_whole(monkeypatch):
    r = np.random.default_rng(3)
    rows = np.stack([r.integers(0, 40, 500), r.integers(0, 30, 500)], 1)
    blocks = pa.RecordBatch.from_arrays([pa.array(np.repeat([1, 2], 5)), pa.array([rows[k * 50 : k * 50 + 50].tobytes() for k in range(10)], pa.binary())], ["range", "block"])
    want = [lines._wanted(rows[:250]), lines._wanted(rows[250:])]
    found = pa.Table.from_batches(list(lines._shared([blocks]))).to_pylist()
    assert sorted((x["key"], x["short"]) for x in found if x["key"] is not None) == sorted(map(tuple, np.concatenate([w[0] for w in want]).tolist()))
    assert sorted(x["short"] for x in found if x["key"] is None) == sorted(np.concatenate([w[1] for w in want]).tolist())
    monkeypatch.setattr(lines, "RANGE_BYTES", 1000)
    every = pa.Table.from_batches(list(lines._shared([blocks]))).to_pylist()
    assert sorted((x["key"], x["short"]) for x in every) == sorted(map(tuple, rows.tolist()))


def test_lines_are_cut_in_their_normal_form(monkeypatch):
    r, plain = random.Random(4), ["A b\n\nC d", "one line", "", "\n", "Ünd noch eine\nzeile"]
    odd = [" x", "x ", "a  b", "a\tb", "a \nb", "a\n b", "a\r\nb", "\x0b", " ", "a\x01 b", "a\xa0 b"]
    odd += ["".join(r.choice("Ab \n\t\u2003é") for _ in range(r.randint(0, 12))) for _ in range(2000)]
    texts = [x for k in range(len(odd)) for x in (odd[k], plain[k % 5], None)]
    want = [lines.normal_lines((t or "").encode()) for t in texts]
    assert lines.lines_of(pa.array(texts)) == want == lines.lines_of(pa.array(["a  b", *texts]))[1:] and lines.lines_of(pa.array([], pa.string())) == []
    monkeypatch.setattr(lines, "normal_lines", None)  # texts with single spaces only don't need it
    assert lines.lines_of(pa.array(plain)) == [t.encode().lower().split(b"\n") for t in plain]


def test_signatures_are_of_single_lines():
    r = random.Random(5)
    own = ["".join(r.choice("abc é日") for _ in range(r.randint(20, 90))).encode() for _ in range(200)] + [bytes(r.choices(b"abcd ", k=r.randint(20, 90))) for _ in range(200)]
    r.shuffle(own)
    assert (lines.signed(own) == np.concatenate([lines.signed([x]) for x in own])).all()
    want = [{x.decode()[p : p + 6] for p in range(len(x.decode()) - 5)} for x in own]
    found = lines.shingle_sets(own)
    assert [len(x) for x in found] == [len(x) for x in want]
    assert all(len(np.intersect1d(found[k], found[k + 1])) == len(want[k] & want[k + 1]) for k in range(399))


def test_units_of_two_are_compared_together(spark):
    r = np.random.default_rng(6)
    rows = []
    for key in range(300):
        s = r.integers(0, 256, 56).astype(np.uint8)
        for k in range(int(r.integers(1, 5))):
            t = s.copy()
            t[: r.integers(0, 48)] += np.uint8(k)
            rows.append((key, bytearray(b"%d-%d" % (key, k)), bytearray(t.tobytes())))
    rows += rows[:50]  # repeated ones

    def one(payloads):
        assert len(payloads) > 2
        return lines.by_signature(payloads)

    one.two = lines.by_signature.two
    df, schema = spark.createDataFrame(rows, "key long, node binary, payload binary"), ["key"]
    got = components._linked(df, schema, one).collect()
    want = components._linked(df, schema, lambda p: lines.by_signature(p)).collect()
    assert sorted((bytes(x.a), bytes(x.b)) for x in got) == sorted((bytes(x.a), bytes(x.b)) for x in want) and len(got) > 100
    number = {bytes(r[1]): k for k, r in enumerate(rows)}
    numbered = spark.createDataFrame([(k, number[bytes(n)], p) for k, n, p in rows], "key long, node long, payload binary")
    for limit in (3, 100):  # nodes may be numbers
        links = components.spanning(numbered, numbered.groupBy("key").count().toDF("key", "n"), one if limit == 100 else lines.by_signature, limit).collect()
        same = {r.node: r.component for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
        assert all(same[number[bytes(x.a)]] == same[number[bytes(x.b)]] for x in got) and len(same) == len({bytes(y) for x in got for y in x})


def test_lines_of_repeated_rows(frame):
    text = "One line that is long enough to be compared.\nAnother line that is just as long as it has to be."
    got = lines.drop_lines(frame([(1, text), (1, text), (2, text), (None, text)])).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, ""), (1, text), (1, text), (2, "")]


def test_short_lines_by_their_normal_form(frame, documents):
    rows = [(1, "les.\n\nand ornd.\nquite short"), (2, "Les. \n\nand ornt.\n\nand  ornd."), (3, "}\n}"), (4, "日本語"), (5, "日本語\nles.")]
    got = {r.doc_id: r.text for r in lines.drop_lines(frame(rows)).collect()}
    assert got == {1: rows[0][1], 2: "\nand ornt.\n", 3: "}", 4: "日本語", 5: ""}


def test_op8_against_brute_force(spark, sf, documents):
    want, texts = brute.kept_lines(documents), dict(documents)
    rows = queries.op8_line_dedup(spark, sf).collect()
    assert {r.doc_id: r.text_sha256 for r in rows} == {i: brute.sha(t or "") for i, t in want.items()}
    gone = [texts[r.doc_id].split("\n")[int(k)] for r in rows for k in (r.removed or "").split(",") if k]
    assert any(len(brute.normal(x)) < lines.WHOLE for x in gone) and any(len(brute.normal(x)) >= lines.WHOLE for x in gone)
    assert all(r.n_removed == len([k for k in (r.removed or "").split(",") if k]) for r in rows)


def test_lines_of_rows_that_share_an_id(frame):
    one, two, three, four = (f"Line of its own about {w}, long enough to be compared." for w in ("apples in winter", "seven green rivers", "an old clockmaker", "tall paper ships"))
    for key in (None, 9):
        rows = [(1, one), (key, f"{one}\n{two}"), (key, f"{three}\n{four}"), (key, f"{four}\n{three}")]
        got = [r.text for r in lines.drop_lines(frame(rows)).collect() if r.doc_id == key]
        # Only line 0 of the first is a copy of another document's; of the other two rows, one keeps both lines and one loses both.
        assert sorted(got) in (sorted([two, f"{three}\n{four}", ""]), sorted([two, "", f"{four}\n{three}"]))


def test_decontamination(spark, frame, documents, odd, monkeypatch):
    items = [(k, " ".join(f"item{k}word{j}" for j in range(14))) for k in range(5)] + [(7, "only three words"), (7, "only three words"), (8, ""), (9, None), (None, "ignored item here")]
    rows = [*documents[:60], *odd, (900, "x " + items[2][1].upper().replace(" ", ", ") + " y"), (901, "and Only? three -- words; it"), (902, " ".join(items[1][1].split()[:10])), (903, " ".join(items[1][1].split()[:9]))]
    bench = frame(items, "item_id long, text string")
    known = [(i, t) for i, t in items if i is not None]
    want = sorted(repr((i, *brute.contaminated(t, known))) for i, t in rows)
    for size in (decontaminate.SLICE_BYTES, 150):
        monkeypatch.setattr(decontaminate, "SLICE_BYTES", size)
        got = decontaminate.decontaminate(clashing(frame(rows)), bench).collect()
        assert sorted(repr((r.doc_id, r.n_words, r.n_hit, r["items"])) for r in got) == want
        kept = decontaminate.drop_contaminated(clashing(frame(rows)), bench)
        assert kept.count() == sum(brute.contaminated(t, known)[1] == 0 for _, t in rows)
    assert decontaminate.decontaminate(frame(rows), bench.where("false")).where("n_hit > 0").count() == 0
    assert decontaminate.decontaminate(frame([]), bench).count() == 0


def test_tables_of_a_slice_are_small():
    import pickle
    import time

    r, words = random.Random(4), [f"w{k}" for k in range(5000)]
    items = [(str(k), " ".join(r.choice(words) for _ in range(200))) for k in range(decontaminate.SLICE_BYTES // 1200)]
    began = time.process_time()
    searcher = decontaminate.Searcher(items, 10)
    assert time.process_time() - began < 30 and len(pickle.dumps(searcher)) < 48 << 20


def test_long_texts_take_many_cursors(frame):
    item = " ".join(f"q{j}" for j in range(12))
    text = " ".join(f"f{j % 97}" for j in range(3000)) + " " + item + " " + " ".join(f"g{j % 89}" for j in range(3000)) + " " + item
    got = decontaminate.decontaminate(frame([(1, text)]), frame([(1, item)], "item_id long, text string")).first()
    assert (got.n_words, got.n_hit) == (6024, 24)
