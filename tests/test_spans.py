import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanlake.operators import spans as E


def overlap(a, b):
    return a[0] < b[1] and b[0] < a[1]


def longest_spec(rows):
    kept = []
    for c in sorted(rows, key=lambda s: (s[0], -(s[1] - s[0]), s[2])):
        rivals = [k for k in kept if overlap(c, k)]
        if not any(k[1] - k[0] >= c[1] - c[0] for k in rivals):
            kept = [k for k in kept if k not in rivals] + [c]
    return sorted(kept)


def greedy_spec(rows):
    kept, cursor = [], -1
    for s in sorted(rows, key=lambda s: (s[0], -(s[1] - s[0]), -(s[3] or 0.0), s[2])):
        if s[0] >= cursor:
            kept.append(s)
            cursor = s[1]
    return sorted(kept)


def many_spans(seed, docs=25):
    rng = random.Random(seed)
    rows = []
    for d in range(docs):
        for i in range(rng.randint(0, 40)):
            a = rng.randint(0, 60)
            rows.append((d, i, a, a + rng.randint(1, 15), rng.choice(["X", "Y Z"]), rng.choice([None, 0.1, 0.5, 0.9])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, seq int, start int, end int, label string, score double")


def by_doc(rows):
    out = {}
    for d, seq, a, b, _, s in rows:
        out.setdefault(d, []).append((a, b, seq, s))
    return out


def test_overlap_resolution(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for seed in (1, 2):
            rows = many_spans(seed)
            got, long = {}, {}
            for r in E.non_overlapping(frame(spark, rows)).collect():
                got.setdefault(r.doc_id, []).append((r.start, r.end, r.seq, r.score))
            for r in E.longest_spans(frame(spark, rows)).collect():
                long.setdefault(r.doc_id, []).append((r.start, r.end, r.seq, r.score))
            assert {d: sorted(v, key=str) for d, v in got.items()} == {d: sorted(greedy_spec(v), key=str) for d, v in by_doc(rows).items()}
            assert {d: sorted(v, key=str) for d, v in long.items()} == {d: sorted(longest_spec(v), key=str) for d, v in by_doc(rows).items()}
        assert E.longest_spans(frame(spark, [])).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10000)


def test_a_long_span_ousts_the_one_before(spark):
    rows = [(1, 0, 0, 4, "X", 0.5), (1, 1, 3, 20, "X", 0.5), (1, 2, 5, 8, "X", 0.5), (1, 3, 20, 22, "X", 0.5)]
    assert [r.seq for r in E.longest_spans(frame(spark, rows)).orderBy("seq").collect()] == [1, 3]


def test_spans_without_an_offset_go(spark):
    rows = [(1, 0, None, 4, "X", 0.5), (1, 1, 3, None, "X", 0.5), (1, 2, 5, 8, "X", 0.5), (1, 3, 9, 12, "X", 0.5)]
    assert [r.seq for r in E.longest_spans(frame(spark, rows)).orderBy("seq").collect()] == [2, 3]
    assert [r.seq for r in E.non_overlapping(frame(spark, rows)).orderBy("seq").collect()] == [2, 3]


def test_overlap_pairs(spark):
    rows = many_spans(3)
    got = sorted((r.doc_id, r.a, r.b) for r in E.overlap_pairs(frame(spark, rows), key="seq", width=8).collect())
    want = sorted((x[0], x[1], y[1]) for x in rows for y in rows if x[0] == y[0] and x[1] < y[1] and overlap(x[2:4], y[2:4]))
    assert got == want


def test_overlaps_of_spans_of_all_lengths(spark):
    rng = random.Random(12)
    rows = [(d, i, a, a + int(8 ** rng.uniform(0, 6)), "X", None) for d in range(3) for i in range(150) for a in [rng.randint(0, 3000)]]
    rows += [(0, 900, 64, 128, "X", None), (0, 901, 0, 64, "X", None), (0, 902, 63, 65, "X", None), (0, 903, 5, 5, "X", None), (0, 904, None, 9, "X", None), (0, 905, 0, 512, "X", None), (0, 906, 511, 513, "X", None)]
    for width in (1, 8, 64):
        got = sorted((r.doc_id, r.a, r.b) for r in E.overlap_pairs(frame(spark, rows), key="seq", width=width).collect())
        real = [x for x in rows if x[2] is not None and x[2] < x[3]]
        assert got == sorted((x[0], x[1], y[1]) for x in real for y in real if x[0] == y[0] and x[1] < y[1] and overlap(x[2:4], y[2:4]))


def test_a_long_span_is_a_bounded_number_of_rows(spark):
    long = [(0, i, 7 * i, 7 * i + n, "X", None) for i, n in enumerate([1, 63, 64, 65, 5000, 100_000, 10**8])]
    binned = E._binned(frame(spark, long), "doc_id", "seq", 64)
    levels = binned.agg(F.sort_array(F.collect_set("level"))).scalar()
    rows = {r.k: r["count"] for r in E._probes(binned, levels, 64).groupBy("k").count().collect()}
    assert rows.keys() == set(range(7)) and max(rows.values()) <= 3 * 5  # a row for every 64 characters would be 1.5 million


def test_markup_both_ways(spark):
    docs = spark.createDataFrame([(0, "Ab cd 😀 ef"), (1, "none"), (2, "")], "doc_id long, text string")
    m = frame(spark, [(0, 0, 0, 2, " NEW LABEL ", 0.9), (0, 1, 1, 4, "X", 0.9), (0, 2, 6, 7, "EMO", None), (0, 3, 8, 10, "Z", 0.1)])
    out = {r.doc_id: r.decorated for r in E.decorate(docs, m).collect()}
    assert out == {0: "[Ab](NEW_LABEL) cd [😀](EMO) [ef](Z)", 1: "none", 2: ""}
    back = E.parse_markup(E.decorate(docs, m).withColumnRenamed("decorated", "markdown")).orderBy("start").collect()
    assert [(r.entity, r.label, r.start, r.end, r.markdown_start, r.markdown_end, r.annotation_start, r.annotation_end) for r in back] == [
        ("Ab", "NEW_LABEL", 0, 2, 1, 3, 0, 15), ("😀", "EMO", 6, 7, 20, 21, 19, 27), ("ef", "Z", 8, 10, 29, 31, 28, 35),
    ]
    clean = E.decorate(docs, m).select("doc_id", E.clean_markup(F.col("decorated")).alias("c")).collect()
    assert {r.doc_id: r.c for r in clean} == {0: "Ab cd 😀 ef", 1: "none", 2: ""}


def occurrence_spec(text, entity, near, ranges):
    found = [i for i in range(len(text) - len(entity) + 1) if text.startswith(entity, i) and not any(i < b and i + len(entity) > a for a, b in ranges)] if entity else []
    if not found:
        return None
    at = found[0] if near is None else min(found, key=lambda i: abs(i - near))
    return at, at + len(entity)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab", max_size=25), st.text(alphabet="ab", max_size=3), st.one_of(st.none(), st.integers(0, 30)), st.lists(st.integers(0, 22), max_size=5))
def test_best_occurrence(text, entity, near, taken):
    ranges, t = [], E._Taken()
    for a in sorted(set(taken)):
        if t.free(a, a + 2):
            t.add(a, a + 2)
            ranges.append((a, a + 2))
    assert E.best_occurrence(text, entity, near, t) == occurrence_spec(text, entity, near, ranges)


def test_search_widens(monkeypatch):
    monkeypatch.setattr(E, "REACH", 1)
    rng = random.Random(6)
    for _ in range(1500):
        text = "".join(rng.choices("ab", k=rng.randint(0, 40)))
        entity, near = "".join(rng.choices("ab", k=rng.randint(1, 4))), rng.randint(-5, 60)
        ranges, t = [], E._Taken()
        for a in sorted(rng.sample(range(40), 6)):
            if t.free(a, a + 2):
                t.add(a, a + 2)
                ranges.append((a, a + 2))
        assert E.best_occurrence(text, entity, near, t) == occurrence_spec(text, entity, near, ranges)


def test_places_against_one_search_each():
    rng = random.Random(7)
    for _ in range(300):
        text = "".join(rng.choices(["ab", "abc", "b", " "], k=60))
        wanted = [(rng.choice(["ab", "abc", "b", "", "zz"]), rng.choice([None, rng.randint(0, 100)])) for _ in range(40)]
        ranges, want = [], []
        for surface, near in wanted:
            want.append(occurrence_spec(text, surface, near, ranges))
            if want[-1]:
                ranges.append(want[-1])
        assert E.places(text, wanted) == want


class CountingText(str):
    """A text that counts the characters its searches and slices pass over."""

    seen = 0

    def find(self, x, a=0, b=None):
        at = str.find(self, x, a, len(self) if b is None else b)
        CountingText.seen += (at if at >= 0 else min(len(self), len(self) if b is None else b)) - a + len(x)
        return at

    def rfind(self, x, a=0, b=None):
        at = str.rfind(self, x, a, len(self) if b is None else b)
        CountingText.seen += max(0, min(len(self), len(self) if b is None else b) - (at if at >= 0 else a))
        return at


def test_work_of_placing_doubles_with_the_text():
    steps = []
    for n in (500, 1000, 2000, 4000):
        names = [f"Name{100 + i % 97}" for i in range(n)]
        text = CountingText(" some filler words ".join(names))
        wanted = [(x, i * (len(text) + 19) // n + 3) for i, x in enumerate(names)] + [("not there", 5)] * 50 + [("Name103", None)] * n
        CountingText.seen = 0
        E.places(text, sorted(wanted, key=lambda w: -len(w[0])))
        steps.append(CountingText.seen)
    assert all(b < 2.5 * a for a, b in zip(steps, steps[1:]))  # eight times the text, about eight times the work


def test_splicing(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        text = "".join(rng.choices("aé漢😀 ", k=rng.randint(0, 30)))
        cuts = sorted(rng.choices(range(len(text) + 1), k=rng.choice([0, 2, 4, 6])))
        edits = [(a, b, rng.choice(["", "X", "long put", None])) for a, b in zip(cuts[::2], cuts[1::2])]
        rows.append((i, text, edits))
    rows += [(100, None, [(0, 1, "x")]), (101, "stays", None), (102, "stays", []), (103, "ab", [(1, 1, "+"), (1, 1, "-"), (2, 2, "!")])]
    df = spark.createDataFrame(rows, "id int, text string, edits array<struct<start:int,end:int,put:string>>").repartition(3)

    def spec(text, edits):
        if text is None or edits is None:
            return text
        for a, b, put in reversed(edits):
            text = text[:a] + (put or "") + text[b:]
        return text

    got = {r.id: r.out for r in df.select("id", E.spliced(F.col("text"), F.col("edits")).alias("out")).collect()}
    assert got == {i: spec(text, edits) for i, text, edits in rows}


def test_contexts_of_markup(spark):
    docs = spark.createDataFrame([(0, "one [Ab](X) and\n\n two [Cd](Y Z)"), (1, None), (2, "[all](L)")], "doc_id int, markdown string")
    got = {(r.doc_id, r.mention): r.context for r in E.parse_markup(docs, context=4).collect()}
    assert got == {(0, 0): "one Ab and", (0, 1): "two Cd", (2, 0): "all"}
    assert "context" not in E.parse_markup(docs).columns


def test_masking_and_recall(spark):
    text = "alpha beta alpha gamma alphabet"
    m = lambda e, s=None, label="L", c=None: {"entity": e, "label": label, "start": s, "end": None if s is None else s + len(e), "context": c}
    given = [m("alpha", 12), m("alphabet", 23), m("alpha"), m("nope", 1, c="ctx"), m("", 2), m("beta", 6, label=" ")]
    kind = "id int, body string, mentions array<struct<entity:string,label:string,start:int,end:int,context:string>>"
    df = spark.createDataFrame([(1, text, given), (2, "", []), (3, None, None)], kind)
    masked, masks, unmatched, master = E.mask(df.where("id = 1")).select("masked_text", "masks", "unmatched", "master").first()
    assert masked == "***** beta ***** gamma ********" and len(masked) == len(text)
    assert [(x["start"], x["end"]) for x in masks] == [(0, 5), (11, 16), (23, 31)]
    assert sorted(x["reason"] for x in unmatched) == ["empty entity or label"] * 2 + ["no free exact occurrence"]
    # an offset of 0 comes last among the mapped ones, unmapped ones after all
    assert [(x["entity"], x["start"]) for x in master] == [("alpha", 11), ("alphabet", 23), ("alpha", 0), ("nope", None)]
    wanted = [("gamma", "G"), ("gamma", "H"), ("beta", "B"), ("", "x")]
    found = E.recall(spark.createDataFrame([(text, masked, wanted)], "body string, masked_text string, found array<struct<entity:string,label:string>>")).first().recalled
    assert [(x["entity"], x["start"], x["source_pass"]) for x in found] == [("gamma", 17, "llm_masked_pass"), ("gamma", None, "llm_masked_pass_unmapped"), ("beta", 6, "llm_masked_pass")]
    out = {r.id: r for r in E.mask(df).collect()}
    assert out[1].masked_text == masked and len(out[1].masks) == 3 and out[2].masked_text == "" and out[3].master == []


def merge_spec(rows):
    fold = lambda s: " ".join(s.casefold().split())
    big = 10**12
    out = []
    for e in sorted(rows, key=lambda e: (e["global_start"] is None, e["global_start"] or big, e["chunk"], e["start"] is None, e["start"] or big, -len(e["entity"]), e["label"], e["source_pass"], e["seq"])):
        same = lambda k, e=e: fold(k["entity"]) == fold(e["entity"]) and k["label"].casefold() == e["label"].casefold()
        again = False
        for k in out:
            if None not in (e["global_start"], k["global_start"]):
                a, b = (e["global_start"], e["global_end"]), (k["global_start"], k["global_end"])
                again |= a == b or (overlap(a, b) and same(k))
            if e["chunk"] == k["chunk"]:
                if None not in (e["start"], k["start"]):
                    a, b = (e["start"], e["end"]), (k["start"], k["end"])
                    again |= a == b or overlap(a, b)
                else:
                    again |= same(k)
        if not again:
            out.append(e)
    return sorted(e["seq"] for e in out)


def test_merge(spark):
    rng = random.Random(8)
    for _ in range(4):
        rows = []
        for seq in range(120):
            a = rng.choice([None, *range(0, 30)])
            chunk = rng.randint(0, 2)
            entity = rng.choice(["ab", "AB ", "cde", "ß", "ss"])
            g = None if a is None or rng.random() < 0.2 else a + 20 * chunk
            n = rng.randint(1, 4)
            rows.append({"run": 1, "entity": entity, "label": rng.choice(["L", "l", "M"]), "chunk": f"chunk_{chunk}", "start": a, "end": None if a is None else a + n, "global_start": g, "global_end": None if g is None else g + n, "source_pass": rng.choice(["p1", "p2"]), "seq": seq})
        df = spark.createDataFrame([tuple(r.values()) for r in rows], "run int, entity string, label string, chunk string, start int, end int, global_start int, global_end int, source_pass string, seq int")
        assert sorted(r.seq for r in E.merge_master(df, ["run"]).collect()) == merge_spec(rows)


def island_spec(rows):
    out, reach, begin = {}, None, None
    for a, b, i in sorted(rows):
        if reach is None or a > reach:
            begin = a
        reach = b if reach is None else max(reach, b)
        if begin == a and out.get(i) is None:
            out[i] = begin
        out[i] = begin
    return out


def test_islands(spark):
    for seed, parts in ((1, 3), (2, 9), (3, 40)):
        rng = random.Random(seed)
        rows = [(rng.choice([1, 1, 1, 2, None]), a, a + rng.choice([0, 1, 3, 60]), i) for i in range(300) for a in [rng.randint(0, 2500)]]
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = {r.i: r.island for r in E.islands(spark.createDataFrame(rows, "doc int, start int, end int, i int"), ["doc"]).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
        want = {}
        for doc in (1, 2, None):
            want |= island_spec([(a, b, i) for d, a, b, i in rows if d == doc])
        assert got == want


def test_merge_in_parts_is_the_merge(spark):
    for seed in range(6):
        rng = random.Random(seed)
        rows = []
        for seq in range(160):
            doc, chunk = rng.choice([1, 1, 1, 2]), rng.randint(0, 5)
            a, n = rng.choice([None, *range(60)]), rng.randint(1, 5)
            g = None if a is None or rng.random() < 0.2 else a + 45 * chunk  # chunks overlap
            torn = seed >= 4 and doc == 2 and rng.random() < 0.3  # offsets that don't go together
            rows.append((doc, rng.choice(["ab", "AB ", "cde", "ß", "ss"]), rng.choice(["L", "l", "M"]), f"chunk_{chunk}", a, None if a is None else a + n, g, None if g is None else g + n + torn, rng.choice(["p1", "p2"]), seq))
        df = spark.createDataFrame(rows, "doc int, entity string, label string, chunk string, start int, end int, global_start int, global_end int, source_pass string, seq int").repartition(5)
        names = df.columns
        want = sorted(x for d in (1, 2) for x in merge_spec([dict(zip(names, r)) for r in rows if r[0] == d]))
        for most in (0, 70, 10**6):
            got = E.merge_parts(df, ["doc"], most=most)
            assert got.columns == names and sorted(r.seq for r in got.collect()) == want


def test_project(spark):
    m = spark.createDataFrame([(1, 0, 2, 5), (1, 1, 0, 3), (2, 0, 1, 2), (1, 0, None, 4)], "doc int, chunk int, start int, end int")
    c = spark.createDataFrame([(1, 0, 100, 9), (1, 1, 200, 2)], "doc int, chunk int, char_start int, n int")
    got = E.project(m, c, ["doc", "chunk"]).collect()
    assert sorted(((r.global_start, r.global_end) for r in got), key=str) == [(102, 105), (200, 203), (None, None), (None, None)]
    with pytest.raises(Exception, match="outside its chunk"):
        E.project(m, c, ["doc", "chunk"], chars="n").collect()
