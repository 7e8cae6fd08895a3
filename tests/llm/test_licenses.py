import random
import textwrap

from spanlake.llm import licenses as L
from tests.llm.test_decontaminate import words as plain_words


def brute(text):
    w = plain_words(text)
    places = sorted((i, label) for phrase, label in L.PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split())
    matches = []
    starts = [0] if len(w) <= L.BLOCK else list(range(0, len(w) - L.BLOCK // 2, L.BLOCK // 2))
    for s in starts if w else []:
        met = {}
        for n, (_, t, own) in enumerate(L.TEMPLATES):
            size = len(plain_words(t)) + max(1, len(plain_words(t)) // 4)
            t = set(plain_words(t))
            block = w[s : s + L.BLOCK]
            stretches = [t & set(block[i : i + size]) for i in range(len(block))]
            best = max((m for m in stretches if set(own.split()) <= m), key=len, default=set())
            if best and len(best) / len(t) >= L.THRESHOLD - 1e-9:
                met[n] = (best, len(t))
        for n, (m, size) in met.items():
            if not any(m < other for other, _ in met.values()):
                matches.append((s, min(s + L.BLOCK, len(w)), L.TEMPLATES[n][0], n, len(m) / size))
    return len(w), places, sorted(matches)


def labels(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    return [r.labels for r in L.verdict(L.scan(df)).orderBy("doc_id").collect()]


def test_no_license_stands_for_another(spark):
    rows = {
        "Licensed under the Mozilla Public License, Version 2.0": "mpl",
        "Released under the Apache License": "apache",
        "Released under the BSD license.": "bsd",
        "Licensed under CC BY-NC 4.0": "cc-by-nc",
        "Licensed under CC BY-SA 4.0": "cc-by-sa",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa",
        "Released under the MIT License": "mit",
        "The license was released under public pressure in all regions": "",
        "We all have human rights. A table was reserved.": "",
        "the cc of this mail went to sa and was licensed under no 4 by 0": "",
        "This free and open release of the film into the domain is not unencumbered by public software": "",
        "Licensed under CC BY-NC-SA 4.0": "cc-by-nc-sa",
        "Licensed under CC BY 4.0": "cc-by",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License": "cc-by-nc-sa",
    }
    assert labels(spark, rows) == list(rows.values())


def test_wrapped_notices(spark):
    """Notices in lines of 60 characters, after other text."""
    want = [(label, t) for label, t, _ in L.TEMPLATES if len(t.split()) >= 10]
    rows = ["Some words before.\n" * 9 + "\n".join(textwrap.wrap(t, 60)) + "\nand after" for _, t in want]
    assert [label in x.split(",") for x, (label, _) in zip(labels(spark, rows), want)] == [True] * len(want)


def texts():
    rng = random.Random(9)
    vocab = [w for _, t, _ in L.TEMPLATES for w in t.split()] + [f"f{i}" for i in range(30)]
    out = ["", None, "MIT license MIT License.\nmit\nlicense", "General Public\nLicense", "licensemit", "É all Rights reserved!"]
    for _ in range(80):
        lines = []
        for _ in range(rng.randint(1, 4)):
            if rng.random() < 0.5:
                w = rng.choice(L.TEMPLATES)[1].split()
                for _ in range(rng.choice([0, 1, 2, 4])):
                    w[rng.randrange(len(w))] = rng.choice(vocab)
                rng.shuffle(w)
                w = rng.choices(vocab[-30:], k=rng.choice([0, 3, 50, 150])) + w
            else:
                w = rng.choices(vocab, k=rng.randint(0, 90))
            lines.append(" ".join(w))
        out.append("\n".join(lines))
    return out + ["the of to " * 60000 + "All rights reserved"]


def test_scan_against_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS places", "'a' AS label")
    got = {r.doc_id: (r.n_words, [(p.word, p.label) for p in r.places], sorted((m.start, m.end, m.label, m.template, m.containment) for m in r.matches)) for r in L.scan(df).collect()}
    assert got == {i: brute(t) for i, t in rows}
    out = {r.doc_id: r for r in L.verdict(L.scan(df)).collect()}
    assert (out[0].n_base, out[0].first_word, out[0].base_labels, out[0].labels, out[0].score) == (0, None, "", "", 0.0)
    assert (out[2].n_base, out[2].first_word, out[2].last_word, out[2].labels, out[2].score) == (3, 0, 4, "mit", 1.0)
    assert out[5].labels == "all-rights-reserved" and out[5].score == 1.0


def test_other_thresholds_and_empty(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma"), (1, "alpha beta"), (None, "delta")], "doc_id long, text string")
    t = [("x", "alpha beta gamma delta", "")]
    for threshold, want in ((0.5, [(1, 1), (1, 1), (None, 0)]), (0.75, [(1, 0), (1, 1), (None, 0)]), (1.0, [(1, 0), (1, 0), (None, 0)])):
        got = [(r.doc_id, len(r.matches)) for r in L.scan(df, templates=t, threshold=threshold).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert L.verdict(L.scan(df.limit(0))).count() == 0
