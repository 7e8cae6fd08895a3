import random

import corpus_pipeline
import numpy as np

from spanlake.llm import pieces, quality
from tests.llm.test_decontaminate import brute as brute_contamination
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_simhash import brute_components, brute_fp


def write_tables(spark, d):
    rng = random.Random(12)
    vocab = ["".join(rng.choices("abcdefg", k=rng.randint(2, 7))) for _ in range(150)]
    prose = lambda n: " ".join(rng.choices(vocab, k=n))
    bench = [(i, prose(20)) for i in range(6)] + [(9, None)]
    shared = [prose(12) for _ in range(3)]
    docs, labels = [], []
    for i in range(160):
        lines = [prose(rng.randint(15, 40)) for _ in range(rng.randint(1, 3))]
        if rng.random() < 0.3:
            lines.insert(0, rng.choice(shared))
        if rng.random() < 0.15:
            lines.append(rng.choice(bench[:6])[1])
        text, good = "\n".join(lines), 1
        if rng.random() < 0.2:
            text, good = " ".join(w.upper() + "!!" for w in text.split()), 0
        elif docs and rng.random() < 0.15:
            text = docs[rng.randrange(len(docs))][1]
            good = int(not text.endswith("!!"))
        docs.append((i, text))
        labels.append((i, good, 0))
    docs += [(500, None), (501, ""), (502, "x"), (503, prose(9000))]
    rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS n_lines", "2 AS row", "3 AS _gone", "cast(null AS string) AS node", "array(1) AS hits").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return docs, labels, bench


def test_stages_against_brute_force(spark, tmp_path):
    docs, labels, bench = write_tables(spark, str(tmp_path))
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = df.columns
    model = quality.train(df, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    text = [(t or "").encode() for _, t in docs]
    scores = [quality.score(model, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in text]
    want = [d for d, s in zip(docs, scores) if s >= 0.3]
    assert 0 < len(want) < len(docs)
    good = {i for i, q, _ in labels if q}
    assert good <= {i for i, _ in want}, "clean documents stay"
    stages = [lambda r: r, brute_lines, None, None]

    def near(rows):
        comp = brute_components({i: brute_fp(t) for i, t in sorted(rows, key=lambda r: r[0])})
        return [(i, t) for i, t in rows if comp[i] == i]

    def clean(rows):
        found = brute_contamination(rows, bench)
        return [(i, t) for i, t in rows if not found[i][3]]

    stages[2:] = [near, clean]
    for (name, stage), expect in zip(corpus_pipeline.STAGES, stages):
        df = stage(spark, df, str(tmp_path))
        df.write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
        assert df.columns == columns
        want = expect(want)
        assert sorted(((r.doc_id, r.text) for r in df.collect()), key=str) == sorted(want, key=str), name
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in df.collect())
    out = {r.doc_id: r for r in corpus_pipeline.STAGES[4][1](spark, df, str(tmp_path)).collect()}
    ids = pieces.load().expected([t or "" for _, t in want])
    assert {i: (r.text, list(r.ids), r.n_tokens) for i, r in out.items()} == {i: (t, x, len(x)) for (i, t), x in zip(want, ids)}
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {(r.doc_id, r.n_tokens) for r in whole.collect()} == {(i, r.n_tokens) for i, r in out.items()}
