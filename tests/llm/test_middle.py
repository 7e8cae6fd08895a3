import hashlib
import random
import re

from spanlake.llm import middle as M

TOKENS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by plain string work."""
    text = text or ""
    units = TOKENS.findall(text)
    h = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fixture():
    rng = random.Random(5)
    parts = ["word", "né", "漢字", "😀", " ", "  ", "\n\n", "\t", "\r\n", "\x0b", "\xa0", " ", "<P", "P>", "x\x00y"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 40)))) for i in range(300)]
    rows += [(i, t) for i, t in zip(range(1000, 1100), [None, "", " ", "\n \t", "one", " one", "one ", "a <P> b", "a <S> b", "a <M> b"] * 10)]
    return rows + [(None, "no id at all"), (None, None), (-7, "negative id here"), (3, "same id again"), (3, "same id again"), (2000, "long tail " * 60000), (2003, "z" * 300000), (2004, " " * 200000)]


def test_report_against_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS form", "1L AS n", "array(1) AS pieces").repartition(5)
    got = [tuple(r) for r in M.report(df).collect()]
    want = [(i, n, f, p, m, sha(o), sha(t or "")) for i, t in rows for n, f, p, m, o in [brute(i, t)]]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {"plain", "psm", "spm"} == {x[2] for x in got}


def test_outputs_and_pieces_come_back(spark):
    rows = [(n, t) for n, (_, t) in enumerate(fixture())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = M.transform(df)
    for r in out.collect():
        text = (rows[r.doc_id][1] or "").encode()
        assert r.output == brute(r.doc_id, rows[r.doc_id][1])[4]
        assert b"".join((text, M.SENTINELS)[p.buffer][p.start : p.stop] for p in r.pieces).decode() == r.output
    assert {r.doc_id: r.text for r in M.restored(out).collect()} == {i: t or "" for i, t in rows}


def test_rates_and_seed(spark):
    df = spark.createDataFrame([(i, f"text of {i} words") for i in range(400)], "doc_id long, text string")
    forms = lambda **k: {r.form: r["count"] for r in M.transform(df, **k).groupBy("form").count().collect()}
    assert forms(rate=0) == {"plain": 400} and forms(rate=100, spm=0) == {"psm": 400} and forms(rate=100, spm=100) == {"spm": 400}
    assert 150 < forms()["plain"] < 250
    assert [r.form for r in M.transform(df).orderBy("doc_id").collect()] != [r.form for r in M.transform(df, seed=7).orderBy("doc_id").collect()]


def test_empty_table_and_null_outputs(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert M.report(none).collect() == [] and M.transform(none).collect() == [] and M.restored(M.transform(none)).collect() == []
    odd = spark.createDataFrame([(1, None, None), (2, "a<P>b", "plain")], "doc_id long, output string, form string")
    assert sorted(map(tuple, M.restored(odd).collect())) == [(1, ""), (2, "a<P>b")]


def test_piece_tables():
    table = M.PieceTable.of(b"abcdef").cut(0, 2, 2, 6)
    assert [p[1:] for p in table.pieces] == [(0, 0), (0, 2), (2, 2), (2, 6), (6, 6)]
    again = table.cut(1, 5)
    assert again.content() == b"abcdef" and len(again.pieces) == 7
    order = (3, 0, 4, 2, 1)
    assert table.permuted(order).content() == b"cdefab" and table.permuted(order).inverted(order).pieces == table.pieces
    assert table.sha256() == hashlib.sha256(b"abcdef").hexdigest()


def test_blocks_do_not_matter(monkeypatch):
    texts = [(t or "").encode() for _, t in fixture()[:400]]
    whole = [(M.n_tokens(t), M.token_ends(t, (0, 1, M.n_tokens(t) // 2, M.n_tokens(t))), M.n_chars(t, 0, len(t))) for t in texts]
    monkeypatch.setattr(M, "BLOCK", 3)
    assert [(M.n_tokens(t), M.token_ends(t, (0, 1, M.n_tokens(t) // 2, M.n_tokens(t))), M.n_chars(t, 0, len(t))) for t in texts] == whole
