import math
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spanlake.llm import toxicity as T


def brute_segments(scores):
    """Ruzzo and Tompa's definition: take the best segment (shortest, leftmost), then look left and right of it."""

    def best(lo, hi):
        found = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += scores[j]
                key = (round(total, 6), -(j - i), -i)
                if total > 1e-9 and (found is None or key > found[0]):
                    found = (key, i, j + 1, total)
        return found

    def solve(lo, hi):
        f = best(lo, hi)
        return [] if f is None else [*solve(lo, f[1]), f[1:], *solve(f[2], hi)]

    return solve(0, len(scores))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([-0.5, -0.5, -0.5, 1.1, 2.3, 0.7]), max_size=40))
def test_segments_against_definition(scores):
    got = T.maximal_segments([(i, s) for i, s in enumerate(scores) if s > 0])
    want = brute_segments(scores)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


def brute_log_odds(docs, y, word):
    """Log-odds of a word over those of all documents, straight from the definition: each prefix shrinks to the next shorter one; 0 under the least that counts."""
    base = (sum(y) + 1) / (len(y) + 2)
    rate, n_up = base, None
    for key in [(word[:n], True) for n in range(3, 10) if n < len(word)] + [(word, False)]:
        has = [any((x.startswith(key[0]) and len(x) > len(key[0])) if key[1] else x == word for x in d) for d in docs]
        n = sum(has)
        if not n:
            break
        if n != n_up:
            rate = (sum(v for h, v in zip(has, y) if h) + T.PRIOR * rate) / (n + T.PRIOR)
        n_up = n
    odds = math.log(rate / (1 - rate)) - math.log(base / (1 - base))
    return odds if odds >= T.LEAST else 0.0


def test_scores_against_plain_version():
    rows = corpus(60, 9)
    texts, y = [t.encode() for _, t, _ in rows], [v for *_, v in rows]
    model, docs = T.fit(texts, y), [T.words(t) for t in texts]
    for t in texts[:12] + [b"", b"Scumbagger zzzklmk abc", b"new words only"]:
        w = T.words(t)
        odds = [brute_log_odds(docs, y, x) for x in w]
        assert [T.word_score(model, x) for x in w] == pytest.approx(odds, abs=1e-9)
        found = [(s, model.lam * s - math.log(max(model.k * len(w), 1e-9))) for *_, s in brute_segments([o or -T.COST for o in odds])]
        top = max([T.FLOOR] + [e for _, e in found])
        total = sum(max(e, 0) for _, e in found if 1 - math.exp(-math.exp(min(50, -e))) <= T.SIGNIFICANT)
        z = model.weights[0] + model.weights[1] * top + model.weights[2] * math.log(1 + total)
        got = T.score(model, T.evidence(model, len(w), T.maximal_segments(T.token_scores(model, w))))
        assert got == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6)


def corpus(n, seed):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdeé", k=rng.randint(2, 6))) for _ in range(400)]
    out = []
    for i in range(n):
        w = rng.choices(plain, k=rng.randint(15, 150))
        bad = rng.random() < 0.2
        if bad:
            at = rng.randrange(len(w))
            w[at:at] = [x for _ in range(4) for x in (rng.choice(["Scumbag", "zzz" + "".join(rng.choices("klm", k=3))]), rng.choice(plain))]
        out.append((i, " ".join(w), int(bad)))
    return out


def test_held_out_accuracy_passages_and_no_leak(spark):
    rows = corpus(900, 4)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (5002, "w " * 300000), (None, "x")], "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS passages")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (4, 1, None), (5, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in T.classify(docs, labels).collect()}
    assert len(got) == 904 and got[5000].score == got[5001].score < 0.5
    held = [(i, y, t) for i, t, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in rows)
    assert sum(got[i].predicted == y for i, y, _ in held) > 0.95 * len(held)
    for i, y, t in held:
        if y and got[i].predicted:
            w = t.lower().split()
            assert any("scumbag" in w[p.start : p.end] or any(x.startswith("zzz") for x in w[p.start : p.end]) for p in got[i].passages)
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    assert {r.doc_id: r.score for r in T.classify(docs, flipped).collect()} == {i: r.score for i, r in got.items()}


def test_one_class_and_empty(spark):
    docs = spark.createDataFrame([(1, "x"), (2, "y z")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert len({r.score for r in T.classify(docs, labels).collect()}) == 1
    assert T.classify(docs.limit(0), labels.limit(0)).count() == 0
