import random
import zlib

import numpy as np

from spanlake.llm import quality as Q


def direct(model, text):
    """One text, chunk by chunk, with plain loops."""
    size = -(-(len(text) + Q.WIDTH - 1) // Q.BLOCK) * Q.BLOCK
    x = text + bytes(size - len(text) + Q.WIDTH)
    act = [[sum(float(model.embed[x[i + k]] @ model.filters[k][:, f]) for k in range(Q.WIDTH)) for f in range(Q.FILTERS)] for i in range(size - Q.WIDTH + 1)]
    blocks = [np.max(act[i : i + Q.BLOCK], axis=0) for i in range(0, size, Q.BLOCK)]
    chunks = [np.maximum(np.maximum(b, blocks[min(i + 1, len(blocks) - 1)]) + model.bias, 0) for i, b in enumerate(blocks)]
    v = np.r_[np.mean(chunks, axis=0), np.max(chunks, axis=0)] @ model.out + model.out_bias
    return 1 / (1 + np.exp(-v))


def corpus(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(rng.randint(3, 120))]
        junk = rng.random() < 0.3
        out.append((i, " ".join(w.upper() + "!!" for w in words) if junk else " ".join(words), int(not junk)))
    return out


def test_scores_match_direct_convolution():
    rows = corpus(40, 1)
    model = Q.fit([t.encode() for _, t, _ in rows], [y for *_, y in rows], epochs=2)
    texts = [t.encode() for _, t, _ in rows[:6]] + [b"", b"x", b"y" * 300, bytes(5)]
    off = np.r_[0, np.cumsum([len(t) for t in texts])]
    got = Q.score(model, np.frombuffer(b"".join(texts), np.uint8), off)
    assert np.allclose(got, [direct(model, t) for t in texts], atol=1e-4)
    alone = [Q.score(model, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(got, alone, atol=1e-6)


def test_gradients():
    rng = np.random.default_rng(0)
    p = {"embed": rng.normal(0, 0.5, (256, Q.EMBED)), "filters": rng.normal(0, 0.4, (Q.WIDTH, Q.EMBED, Q.FILTERS)), "bias": np.zeros(Q.FILTERS), "out": rng.normal(0, 0.2, 2 * Q.FILTERS), "out_bias": np.zeros(1)}
    texts = [b"hello there " * 30, b"WHAT!!"]
    raw, off, y = np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])], np.array([1.0, 0.0])

    def loss(q):
        s = Q.score(Q.Model(q["embed"], q["filters"], q["bias"], q["out"], float(q["out_bias"][0])), raw, off)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    g = Q._gradients(p, raw, off, y)
    for k, at in (("out", (3,)), ("bias", (2,)), ("filters", (1, 2, 3)), ("embed", (ord("e"), 1)), ("out_bias", (0,))):
        q = {n: v.copy() for n, v in p.items()}
        q[k][at] += 1e-3
        up = loss(q)
        q[k][at] -= 2e-3
        assert abs((up - loss(q)) / 2e-3 - g[k][at]) < 0.05 * abs(g[k][at]) + 2e-4, k


def test_held_out_accuracy_and_no_leak(spark):
    rows = corpus(500, 2)
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in rows] + [(9000, None, "en"), (9001, "", "en"), (9002, "a " * 200000, "en"), (None, "abc", None)], "doc_id long, text string, lang string").selectExpr("*", "1 AS score")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(3, None, 0), (3, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in Q.classify(docs, labels).collect()}
    assert len(got) == 504 and got[9000].score == got[9001].score
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows)
    assert sum(got[i].predicted == y for i, y in held) > 0.95 * len(held)
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    again = {r.doc_id: r.score for r in Q.classify(docs, flipped).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.classify(docs, labels).count() == 1
    assert Q.classify(docs.limit(0), labels).count() == 0
