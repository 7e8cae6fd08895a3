import hashlib
import random
import unicodedata

import numpy as np
import xxhash

from spanlake.llm import bloom
from spanlake.llm import fingerprints as P


def canon(t):
    t = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", t or "").casefold())
    return " ".join(t.split()).encode()


def brute(rows):
    rows = sorted(rows, key=lambda r: (-(2**63) if r[0] is None else r[0], (r[1] or "").encode()))
    out = []
    for n, (i, t) in enumerate(rows):
        t, after = t or "", rows[(n + 1) % len(rows)][1] or ""
        k = len(t) // 4
        e = t[: len(t) - k] + after[:k]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), xxhash.xxh3_128_hexdigest(canon(t)), xxhash.xxh3_128_hexdigest(canon(e)), float(canon(t) == canon(e)), float(canon(t) == canon(after))))
    return out


def fixture(n=150):
    rng = random.Random(2)
    words = ["Alpha", "beta", "ſtraße", "ÉCOLE", "école", "ﬁne", " ", "😀", "x\ty", "K"]
    rows = [(rng.randrange(10**6), " ".join(rng.choices(words, k=rng.randint(0, 30)))) for _ in range(n)]
    rows += [(i + 1, t.upper()) for i, t in rows[:20]] + [(7, None), (8, ""), (9, "  \n"), (None, "null id"), (10, "z" * 300000), (12, "same"), (12, "same"), (12, "other")]
    return rows


def test_report_against_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).selectExpr("*", "1 AS key", "2 AS bucket")
    got = [tuple(r) for r in P.edit_report(df).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_few_rows_and_empty(spark):
    for rows in ([(5, "only one text")], [(5, "abcd"), (6, "WXYZ")], []):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert sorted(tuple(r) for r in P.edit_report(df).collect()) == sorted(brute(rows))


def test_equal_buckets_are_compared_by_bytes(spark):
    weak = lambda b: bytes([len(b) % 3])
    rows = fixture(60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r.fingerprint for r in P.fingerprints(df, digest=weak).orderBy("doc_id").collect()]
    assert len(got) == len(rows) and len(set(got)) == len({canon(t) for _, t in rows})
    by_form = {}
    for r in P.fingerprints(df.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), digest=weak).join(df.dropDuplicates(["doc_id"]), "doc_id").collect():
        assert by_form.setdefault(canon(r.text), r.fingerprint) == r.fingerprint
    strong = P.fingerprints(df).select("fingerprint").distinct().count()
    assert strong == len({canon(t) for _, t in rows})


def test_canonical_is_stable():
    for _, t in fixture():
        once = P.canonical(t or "")
        assert once == canon(t) == P.canonical(once.decode())


def test_bloom_has_no_false_negatives(spark):
    keys = [-5, 0, 7, 2**62, -(2**63)] + list(range(1000, 5000, 37))
    words = bloom.build(spark.createDataFrame([(k,) for k in keys], "k long"), "k", 1 << 16)
    assert bloom.contains(words, np.array(keys, np.int64)).all()
    assert bloom.contains(words, np.arange(10**6, 10**6 + 5000)).mean() < 0.05
