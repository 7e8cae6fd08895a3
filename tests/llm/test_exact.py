import hashlib
import random
import re
from collections import Counter, defaultdict

from spanlake.llm import exact as E


def norm(t):
    return re.sub("[\x20\x09-\x0d]+", " ", t or "")


def first(ids):
    return min(ids, key=lambda i: (i is None, i or 0))


def brute(rows):
    same = defaultdict(list)
    for i, t in rows:
        same[norm(t)].append(i)
    return [(i, first(same[norm(t)]), len(same[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows]


def fixture(n=400):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(["a", "b", "É", "漢", "x y"], k=rng.randint(0, 4)))) for i in range(1, n)]
    rows += [(i, rng.choice(["hot text", "hot  text", "hot\ntext", "hot\t\r\n text"])) for i in rng.sample(range(10**6, 10**7), n // 2)]  # a third of all
    rows += [(0, None), (5000, ""), (5001, " "), (5002, "\n\n"), (-4, "a b"), (None, "a b"), (None, "only without id"), (None, "only without id"), (77, "again"), (77, "again"), (78, "again")]
    return rows + [(6000, "long " * 80000), (6001, "long\n" * 80000), (6002, "long " * 79999)]


def test_report_against_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS digest", "2L AS row", "3 AS keep", "4L AS n").repartition(7)
    want = sorted(brute(rows), key=str)
    for counters in (None, 1, 3, 40):
        got = E.groups(df, counters=counters).selectExpr("doc_id", "keep_id", "group_size", "kept", "lower(hex(digest)) AS sha").collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.sha) for r in got), key=str) == want
        assert sorted(r.sha for r in got if r.kept) == sorted({x[3] for x in want})  # one row stays of each text
        assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in E.report(df).collect()), key=str) == want


def test_rows_that_stay_with_all_their_columns(spark):
    rows = fixture()
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, `digest` int").selectExpr("*", "doc_id AS _id", "text AS _doc", "1 AS _keep", "named_struct('a b', digest) AS `odd.name`").repartition(6)
    for counters in (None, 2):
        got = E.deduplicate(df, counters=counters)
        assert got.dtypes == df.dtypes
        kept = [(r.doc_id, r.text) for r in got.collect()]
        assert all(k in set(rows) for k in kept)
        assert sorted((norm(t), str(i)) for i, t in kept) == sorted({(norm(t), str(k)) for (_, t), (_, k, _, _) in zip(rows, brute(rows))})


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert E.report(none).collect() == [] and E.deduplicate(none).collect() == []


def test_all_rows_the_same_and_all_different(spark):
    same = spark.createDataFrame([(i, "x") for i in range(500)], "doc_id long, text string").repartition(4)
    assert {tuple(r)[1:3] for r in E.report(same).collect()} == {(0, 500)}
    apart = spark.createDataFrame([(i, str(i)) for i in range(500)], "doc_id long, text string").repartition(4)
    assert all(r.kept and r.group_size == 1 for r in E.report(apart).collect())
    assert E.frequent(E.digests(apart), 50).count() == 0


def test_summaries_miss_no_frequent_value(spark):
    for seed in range(4):
        rng = random.Random(seed)
        values = [f"v{int(rng.paretovariate(0.6)) % 5000}".encode() for _ in range(6000)]
        df = spark.createDataFrame([(v,) for v in values], "digest binary").repartition(9)
        true = Counter(values)
        for k in (3, 10, 60):
            found = [bytes(r.digest) for r in E.frequent(df, k).collect()]
            assert len(found) == len(set(found)) <= k + 1
            assert {v for v, n in true.items() if n >= 2 * len(values) / (k + 1) and n > 1} <= set(found)


def test_counters_are_bounded_and_never_too_high():
    rng, true, counters = random.Random(1), Counter(), {}
    for _ in range(50):
        batch = Counter(int(rng.paretovariate(0.8)) % 900 for _ in range(200))
        true += batch
        counters = E.misra_gries(counters, batch, 20)
        assert len(counters) <= 20
        assert all(true[v] - sum(true.values()) / 21 <= counters.get(v, 0) <= true[v] for v in true)
