import random
import re

from spanlake.llm import decontaminate as D
from spanlake.llm.words import count_words

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = {}
    for d, text in docs:
        w, hit, ids = words(text), set(), set()
        for i, item in items:
            x = words(item)
            for k in range(max(1, len(x) - 12) if x else 0):
                win = x[k : k + 13]
                for s in range(len(w) - len(win) + 1):
                    if w[s : s + len(win)] == win:
                        hit |= set(range(s, s + len(win)))
                        ids.add(i)
        out[d] = (len(w), len(hit), sorted(ids), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def fixture():
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(40)] + ["the"] * 30 + ["é", "Ünder"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([3, 12, 13, 14, 40])))) for i in range(25)]
    items += [(90, None), (91, ""), (92, " ,.! "), (93, items[4][1]), (94, "the")]
    docs = []
    for d in range(60):
        w = rng.choices(vocab, k=rng.choice([0, 5, 60, 400]))
        if rng.random() < 0.6:
            x = rng.choice(items)[1] or ""
            w[len(w) // 2 : len(w) // 2] = [x.upper() if rng.random() < 0.3 else x] * rng.choice([1, 2])
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(w)))
    return docs + [(100, None), (101, ""), (102, "!!"), (103, "the")], items


def test_against_brute_force_whole_and_in_blocks(spark):
    docs, items = fixture()
    want = brute(docs, items)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS terms", "'x' AS items")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (D.ITEM_BYTES, 600):
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in D.verdict(D.contamination(df, bench, item_bytes=size)).collect()}
        assert got == want
    kept = sorted(r.doc_id for r in D.decontaminate(df, bench).collect())
    assert kept == sorted(d for d, v in want.items() if not v[3])


def test_proximity_and_empty_tables(spark):
    item = " ".join(f"q{i}" for i in range(13))
    near = item.replace("q6", "q6 oops")
    df = spark.createDataFrame([(1, item), (2, near), (3, "q0 " + " x" * 40 + item[3:]), (4, "q1 q0 " + item[6:])], "doc_id long, text string")
    got = {r.doc_id: (len(r.hits), r.n_near) for r in D.contamination(df, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got == {1: (1, 0), 2: (0, 1), 3: (0, 0), 4: (0, 1)}
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.doc_id: r["items"] for r in D.contamination(df, none).collect()} == {1: [], 2: [], 3: [], 4: []}
    assert D.contamination(df.limit(0), none).count() == 0


def test_count_words():
    import numpy as np

    texts = ["", "a b", "É!x", "", "...", "End", "start 9"]
    raw = "".join(texts).encode()
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    assert count_words(np.frombuffer(raw, np.uint8), off).tolist() == [len(words(t)) for t in texts]
