import hashlib
import math
import pathlib
import random
from collections import defaultdict

import numpy as np
import pytest

from spanlake.llm import codes as C
from spanlake.llm.common import shared_dir

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """[(vec_id, code, error, label_error)], codebooks digest, in plain Python integers."""
    rows = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = len(rows[0][1]) // parts
    books = [[v[p * w : p * w + w] for _, v, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]] for p in range(parts)]
    d = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min((d(v[p * w : p * w + w], b), k) for k, b in enumerate(books[p]))
    for _ in range(rounds):
        got = [[near(v, p)[1] for p in range(parts)] for _, v, _ in rows]
        for p in range(parts):
            new = []
            for k, b in enumerate(books[p]):
                mine = [v[p * w : p * w + w] for (_, v, _), g in zip(rows, got) if g[p] == k]
                new.append([sum(c) // len(mine) for c in zip(*mine)] if mine else b)
            books[p] = new
    out, by_label = [], defaultdict(int)
    for i, v, lab in rows:
        best = [near(v, p) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(e for e, _ in best), lab))
        by_label[lab] += out[-1][2]
    flat = ",".join(str(x) for p in books for b in p for x in b)
    return sorted(((i, c, e, by_label[lab]) for i, c, e, lab in out), key=str), hashlib.sha256(flat.encode()).hexdigest()


def clouds(n, dims, seed=1):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(12)]
    f = lambda x: float(np.float32(x))
    return [(i, [f(x + rng.gauss(0, 0.3)) for x in centers[rng.randrange(12)]], rng.choice([0, 0, 0, 1, 2, None])) for i in rng.sample(range(10 * n), n)]


def report(spark, rows, **k):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS code", "2 AS v", "3 AS low", "'s' AS sums", "4 AS _label").repartition(5)
    got = C.report(df, **k).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=str), {r.codebooks_sha256 for r in got}


def test_against_brute_force(spark):
    rows = clouds(500, 64)
    rows += [(10**6, None, 1), (10**6 + 1, [1.0] * 63 + [None], 1), (10**6 + 2, [float("nan")] * 64, 0), (10**6 + 3, [0.5] * 63 + [-float("inf")], 0)]
    rows += [(None, [0.25] * 64, 2), (None, rows[0][1], None), rows[5], rows[5], (-3, [0.0] * 64, None)]
    want, sha = brute(rows)
    assert report(spark, rows) == (want, {sha})


@pytest.mark.parametrize("dims,parts,entries,rounds", [(8, 8, 4, 3), (16, 2, 200, 4), (6, 3, 1, 2), (8, 1, 5, 0)])
def test_other_shapes(spark, dims, parts, entries, rounds):
    rows = clouds(150, dims, seed=dims)
    want, sha = brute(rows, parts, entries, rounds)
    assert report(spark, rows, parts=parts, entries=entries, rounds=rounds) == (want, {sha})


def test_ties_few_rows_and_unused_entries(spark):
    rows = [(i, [float(i % 3)] * 16, i % 2) for i in range(40)]  # seeds repeat: equal entries, the later ones stay unused
    want, sha = brute(rows)
    assert report(spark, rows) == (want, {sha})
    few = rows[:3]
    want, sha = brute(few)
    assert report(spark, few) == (want, {sha})
    halves = [(i, [float(x)] * 8, 0) for i, x in enumerate([0, 2, 1, 1, 1])]  # as far from one entry as from the other
    want, sha = brute(halves, entries=2)
    assert report(spark, halves, entries=2) == (want, {sha})


def test_large_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [float(np.float32(rng.uniform(-9000, 9000))) for _ in range(16)], 0) for i in range(80)]  # beyond what float64 products hold
    want, sha = brute(rows)
    assert report(spark, rows) == (want, {sha})


def test_odd_lengths_saturation_and_empty(spark):
    made, books = C.compress(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0], 0), (3, [], 0), (4, [3.0e38, -3.0e38, 1.0], 0)], SCHEMA), parts=2, entries=4)
    got = {r.vec_id: (bytes(r.code), r.error) for r in made.collect()}
    assert books.shape == (2, 4, 2) and set(got) == {1, 2, 3, 4} and np.abs(books).max() == C._saturation(4)
    assert all(e == 0 for _, e in got.values())
    none = spark.createDataFrame([], SCHEMA)
    assert C.report(none).collect() == [] and C.report(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
    assert C.report(none).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_codes_stand_for_their_entries(spark):
    rows = clouds(120, 16)
    made, books = C.compress(spark.createDataFrame(rows, SCHEMA), label_col=None)
    for r in C.decompress(made, books).collect():
        want = np.concatenate([books[p][k] for p, k in enumerate(bytes(r.code))]) / C.SCALE
        assert np.allclose(r.embedding, want)


def test_bounds_skip_and_change_nothing():
    rng = np.random.default_rng(4)
    x = rng.integers(-3000, 3000, (12, 4, 6))[rng.integers(0, 12, 900)] + rng.integers(-400, 400, (900, 4, 6))
    history, old, anew = [np.ascontiguousarray(x[:16].transpose(1, 0, 2))], None, []
    for _ in range(7):
        moves = C.net_moves(history)
        new, error, n = C.assign(x, history, old, moves)
        plain, plain_error, _ = C.assign(x, history, None, moves)
        assert (new.code == plain.code).all() and (error == plain_error).all()
        anew.append(n)
        sums = C.added(x, new.code, 16).ravel()
        history.append(C.updated(history[-1], dict(enumerate(sums.tolist()))))
        old = new
    assert anew[0] == x.shape[0] * 4 and anew[-1] < anew[0] / 4
    net = C.net_moves(history)
    for t in range(len(history) - 1):  # the norm of the sum is never more than the sum of the norms
        steps = sum(np.sqrt(((b - a) ** 2).sum(2)) for a, b in zip(history[t:], history[t + 1 :]))
        assert (net[t].max(1) <= steps.max(1) * (1 + 1e-6)).all()


def test_superseded_tables_are_removed(spark):
    place = pathlib.Path(shared_dir(spark)) / "spanlake"
    names = lambda: {p.name for p in place.iterdir()} if place.exists() else set()
    before = names()
    C.compress(spark.createDataFrame(clouds(60, 8), SCHEMA))
    assert [n.split("-")[0] for n in names() - before] == ["codes"]
