"""Nulls, repeated rows, long texts, clashing names and empty tables, where an operator's own tests don't have them."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from spanlake.llm import decontaminate, fingerprints, pieces, quality, simhash, toxicity, warc

CLASH = ["1 AS score", "'x' AS label", "2 AS n_words", "3 AS hits", "array(1) AS fp", "4 AS key", "5 AS bucket", "6 AS predicted", "7 AS held_out", "8 AS passages", "9 AS component_id", "10 AS root", "11 AS node"]
WORDS = "the quick brown fox jumps over a lazy dog while seven wizards pack judges".split()


def docs(spark, more=()):
    rows = [(i, " ".join(WORDS[i % 5 :] * (i % 4 + 1)) + ("!!! BAD STUFF " * 5 if i % 3 == 0 else "")) for i in range(40)]
    rows += [(1, rows[1][1]), (1, rows[1][1]), (2, "another text of id two"), (None, None), (None, ""), (100, None), (101, ""), (102, "long words " * 40000), *more]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *CLASH).repartition(4)


def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 != 0), int(i % 3 == 0)) for i in range(40)] + [(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers(spark, module):
    rows, df = docs(spark)
    got = module.classify(df, labels(spark)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= module.THRESHOLD) for r in got)
    plain = module.classify(spark.createDataFrame(rows, "doc_id long, text string"), labels(spark)).collect()
    key = lambda rs: sorted(((r.doc_id, r.held_out, r.score) for r in rs), key=str)
    assert key(got) == key(plain)  # other columns don't matter
    assert len({r.score for r in got if r.doc_id == 1}) == 1 and len({r.score for r in got if r.doc_id in (None, 100, 101)}) == 1
    assert module.classify(df.limit(0), labels(spark)).collect() == []


def test_decontamination(spark):
    bench = spark.createDataFrame([(7, " ".join(WORDS)), (7, " ".join(WORDS)), (8, None), (None, "seven wizards")], "item_id long, text string").selectExpr("*", "1 AS doc_id")
    rows, df = docs(spark, [(200, "filler " * 50000 + " ".join(WORDS)), (201, " ".join(WORDS)), (201, " ".join(WORDS))])
    got = decontaminate.verdict(decontaminate.contamination(df, bench)).collect()
    assert len(got) == len(rows)
    of = lambda i: sorted((r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got if r.doc_id == i)
    n = len(WORDS)
    assert of(201) == [(n, n, (7,), True)] * 2 and of(200) == [(50000 + n, n, (7,), False)] and of(100) == [(0, 0, (), False)]
    assert decontaminate.contamination(df.limit(0), bench).collect() == [] and not any(r.contaminated for r in decontaminate.verdict(decontaminate.contamination(df, bench.limit(0))).collect())


def test_near_duplicates_and_fingerprints(spark):
    rows, df = docs(spark)
    for f in (simhash.near_duplicates, fingerprints.edit_report):
        plain = f(spark.createDataFrame(rows, "doc_id long, text string"))
        assert sorted(map(tuple, f(df).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str) and plain.count() == len(rows)
        assert f(df.limit(0)).collect() == []


def test_archives(spark):
    pages = spark.createDataFrame([(1, "u", "a"), (2, None, "a"), (2, None, "a"), (3, "v", None), (4, "w", ""), (None, "x", "b")], "page_id long, url string, html string").selectExpr("*", "1 AS payload_bytes", "2 AS record_type", "3 AS member")
    got = warc.round_trip(pages)
    assert got.count() == 6 and warc.round_trip(pages.limit(0)).collect() == []
    of = lambda i: sorted((r.payload_bytes, r.record_type, r.refers_to) for r in got.collect() if r.page_id == i)
    assert of(1) == [(1, "revisit", 2)] and of(4) == [(0, "response", None)] and of(3) == [(0, "revisit", 4)]


def test_pipeline_on_empty_tables(spark, tmp_path):
    rows, df = docs(spark)
    for name, table in (("documents", df.select("doc_id", "text").withColumn("n_chars", F.length("text").cast("long")).limit(0)), ("labels", labels(spark)), ("benchmark", spark.createDataFrame([], "item_id long, text string"))):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.collect() == [] and got.columns[:3] == ["doc_id", "text", "n_chars"]


def test_line_stage_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a line\na line", 5, 6), (2, None, 7, 8)], "doc_id long, text string, _lines_0 int, _lines_1 int").withColumn("n_chars", F.length("text").cast("long"))
    got = sorted(map(tuple, corpus_pipeline.line_dedup(spark, df, "").collect()))
    assert got == [(1, "a line", 5, 6, 6), (2, None, 7, 8, None)]


def test_short_lines_are_compared(spark):
    from spanlake.llm import lines

    got = lines.deduplicate(spark.createDataFrame([(1, "abcd"), (2, "abcde"), (3, "wxyz"), (4, "ab"), (5, "abc")], "doc_id long, text string"))
    assert lines.similar(b"abcd", b"abcde") and all(len(k) for k in lines.line_keys([b"abcd", b"abcde"])) and got.count() == 5


def test_words_of_a_batch_go_in_many_texts(spark):
    codec, seen = pieces.load(), []
    codec.tok  # noqa: B018
    real = codec.library_encode
    codec.library_encode = lambda texts: seen.append(len(texts)) or real(texts)
    words = [f"word{i}x" for i in range(3000)]
    ids, off, agree = codec.encode([" ".join(words)])
    assert max(seen) >= 3000 // pieces.JOINED and ids.tolist() == codec.expected([" ".join(words)])[0] and agree.all()
