import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from spanlake.llm import distances
from spanlake.llm import lines as L

from .test_lines import levenshtein

TEXTS = st.lists(st.tuples(st.text(alphabet="abé漢😀", max_size=25), st.text(alphabet="abé漢😀", max_size=25), st.integers(0, 12)), min_size=1, max_size=40)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_pairs_of_all_sizes_go_together(pairs):
    texts = [x for a, b, _ in pairs for x in (a, b)]
    i = np.arange(0, len(texts), 2)
    got = distances.within(texts, i, i + 1, np.array([k for *_, k in pairs]))
    assert got.tolist() == [levenshtein(a, b) <= k for a, b, k in pairs]


def test_many_pairs_and_long_lines_agree_with_single_comparisons():
    rng = random.Random(1)
    a, b = [], []
    for n in [5, 12, 40, 64, 65, 200, 900, 4090, 4100] * 6 + [30] * 2500:
        x = rng.choices("abcd ", k=n)
        y = list(x)
        for _ in range(int(rng.choice([0.05, 0.15, 0.19, 0.22, 0.5]) * n)):
            y[rng.randrange(n)] = rng.choice("abcdef ")
        a.append("".join(x).encode()), b.append("".join(y[: rng.choice([n, n - n // 20])]).encode())
    want = [L.similar(x, y) for x, y in zip(a, b)]
    assert L.similar_pairs(a, b).tolist() == want and 0 < sum(want) < len(want)
    assert L.similar_pairs(a, b, 0.95).tolist() == [L.similar(x, y, 0.95) for x, y in zip(a, b)]
    assert L.similar_pairs([], []).tolist() == []


def test_lines_of_one_key_are_not_compared_one_pair_at_a_time(monkeypatch):
    rng = random.Random(2)
    parts = ["".join(rng.choices("abcdefgh ", k=30)) for _ in range(5)]
    lines = [" ".join(rng.sample(parts, 5)).encode() for _ in range(60)] + [b"one line of its own", b"one line of its owe"]
    rows = pa.RecordBatch.from_pydict({"part": [1] * 62, "side": [0] * 62, "label": list(range(62)), "id": list(range(62)), "fp": [x.tobytes() for x in L.simhashes(lines)], "line": lines})
    want = {frozenset((x, y)) for x in range(62) for y in range(x) if L.similar(lines[x], lines[y])}
    monkeypatch.setattr(L, "distance_at_most", None)
    got = {frozenset(p) for out in L._across(L.SIMILAR, L.BITS)(iter([rows])) for p in zip(out["a"].to_pylist(), out["b"].to_pylist())}
    assert frozenset((60, 61)) in got and got <= want
