import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spanlake.llm import anchors, suffixes
from spanlake.llm.common import shared_dir


def brute(rows, window):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((d, len(t), len(t) - len(kept), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fixture(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    shared = [prose(rng.choice([40, 70, 200])) for _ in range(4)] + ["The " * 100, "x" * 230]
    rows = []
    for i in range(70):
        t = prose(rng.choice([0, 5, 40, 120, 300]))
        for _ in range(rng.choice([0, 1, 1, 2])):
            s = rng.choice(shared)
            if rng.random() < 0.4:
                a = rng.randrange(len(s))
                s = s[a : a + rng.randint(150, 400)]
            at = rng.randrange(len(t) + 1)
            t = t[:at] + s + t[at:]
        rows.append((i, t))
    for i in range(70, 85):
        t = list(rng.choice(rows)[1])
        for _ in range(rng.choice([0, 1, 3])):
            if t:
                t[rng.randrange(len(t))] = "Z"
        rows.append((i, "".join(t)))
    return rows + [(100, None), (101, ""), (None, rows[3][1]), (5, "other text of one id " * 3), (7, rows[7][1]), (102, prose(30000)), (103, "ab" * 20000)]


def test_against_brute_force(spark):
    for seed, hot in ((1, suffixes.HOT_CLASSES), (2, 3)):
        rows = fixture(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).selectExpr("*", "1 AS row", "2 AS spans")
        got = sorted((tuple(r) for r in suffixes.report(df, hot=hot, most=500).collect()), key=str)
        assert got == brute(rows, 200), seed


def test_other_windows_and_empty(spark):
    rows = [(1, "abcabcabcabc"), (2, "xxabcabcy"), (3, "short"), (4, "qqqqqqq")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in suffixes.report(df, window=6, gram=3).collect()), key=str) == brute(rows, 6)
    assert suffixes.report(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), max_size=5), st.sampled_from([5, 17, 1 << 19]))
def test_anchors_are_those_of_the_content(texts, segment):
    window, gram = 12, 4
    raw = "".join(texts).encode()
    off = np.r_[0, np.cumsum([len(t) for t in texts], dtype=np.int64)]
    a = anchors.find(np.frombuffer(raw, np.uint8), off, window, gram, segment)
    of = {}
    for at, first, last in zip(a.at, a.first, a.last):
        for p in range(first, last + 1):
            assert p not in of and p <= at <= p + window - gram
            of[p] = at - p
    valid = [p for t, s in zip(texts, off) for p in range(s, s + len(t) - window + 1)]
    assert sorted(of) == valid
    place = {}
    for p in valid:
        assert place.setdefault(raw[p : p + window], of[p]) == of[p]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abc", min_size=30, max_size=200), st.sampled_from([3, 8, 13, 20]))
def test_equal_windows(text, window):
    data = np.frombuffer(text.encode(), np.uint8)
    starts = np.arange(len(data) - window + 1)
    label = starts % 2
    n = Counter((text[i : i + window], i % 2) for i in starts.tolist())
    want = [n[text[i : i + window], i % 2] > 1 for i in starts.tolist()]
    assert suffixes.equal_windows(data, starts, label, window).tolist() == want


def test_union():
    s, e = suffixes.union_spans(np.array([10, 0, 5, 30]), np.array([12, 6, 10, 31]))
    assert (s.tolist(), e.tolist()) == ([0, 30], [12, 31])
    assert pytest.approx(0) == len(suffixes.union_spans(np.zeros(0, np.int64), np.zeros(0, np.int64))[0])


def test_tables_between_steps_are_no_files(spark):
    # each file that a task writes to a local folder starts processes that count with the whole memory of their executor
    files = lambda: set(Path(shared_dir(spark).removeprefix("file:")).rglob("*"))
    rows, before = fixture(2), files()
    assert sorted(map(tuple, suffixes.report(spark.createDataFrame(rows, "doc_id long, text string"), hot=3).collect()), key=str) == brute(rows, suffixes.WINDOW)
    assert files() == before
