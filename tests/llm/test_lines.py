import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from spanlake.llm import lines as L


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc", max_size=25), st.text(alphabet="abc", max_size=25), st.integers(0, 12))
def test_distance(a, b, most):
    assert L.distance_at_most(a, b, most) == (levenshtein(a, b) <= most)


def normal(line):
    return " ".join(re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aB é\n.1", max_size=60))
def test_normal_lines(text):
    want = [(i, normal(x).encode()) for i, x in enumerate(text.split("\n")) if normal(x)]
    assert L.normal_lines(text.encode()) == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB é\n.1", max_size=40), min_size=1, max_size=8))
def test_lines_of_many_texts_at_once(texts):
    texts = [x.encode() for x in texts]
    of, number, lines = L.split_lines(texts)
    assert list(zip(of.tolist(), number.tolist(), lines)) == [(t, i, x) for t, text in enumerate(texts) for i, x in L.normal_lines(text)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab é1", max_size=90), min_size=1, max_size=6), st.text(alphabet="abcd ", max_size=4000))
def test_keys_do_not_depend_on_neighbours(texts, long):
    lines = [x.encode() for t in [*texts, long, long.replace(" ", "")] if (x := normal(t))]
    for line, keys in zip(lines, L.line_keys(lines) if lines else []):
        n = len(line.decode())
        assert keys.tolist() == L.line_keys([line])[0].tolist()
        assert len(keys) == L.BANDS * ((L.LEAST <= n <= L.SHORT) + (n >= L.LONG))


def edit_similar(x, y):
    return 1 - levenshtein(x, y) / max(len(x), len(y)) >= L.SIMILAR - 1e-9


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abé \u4e00", min_size=1, max_size=30), st.text(alphabet="abé ", min_size=1, max_size=30))
def test_similar(x, y):
    assert L.similar(x.encode(), y.encode()) == edit_similar(x, y)


@settings(max_examples=30, deadline=None)
@given(st.text(alphabet="abé ", min_size=1, max_size=150), st.lists(st.text(alphabet="abé\u4e00 ", min_size=1, max_size=150), min_size=45, max_size=50), st.integers(0, 60))
def test_many_at_once(x, others, cut):
    others += [x[:cut] + y[cut:] for y in others if x[:cut] + y[cut:]]
    assert L.all_similar(x.encode(), [y.encode() for y in others]) == [edit_similar(x, y) for y in others]


def test_pivots_settle_pairs_rightly():
    rng = random.Random(3)
    base = ["".join(rng.choices("abcde ", k=120)).strip() for _ in range(3)]

    def altered(x, n):
        x = list(x)
        for _ in range(n):
            x[rng.randrange(len(x))] = rng.choice("xyz")
        return "".join(x)

    cousin = altered(base[0], 45)  # like the first family, but not similar to it
    texts = [altered(rng.choice([*base, cousin]), rng.randint(0, 12)) for _ in range(110)] + ["\u4e00" * 100, "", "short"]
    i, j = (x.ravel() for x in np.meshgrid(range(len(texts)), range(len(texts)), indexing="ij"))
    i, j = i[j < i], j[j < i]
    sure, is_open = L._open_pairs(texts, i, j, L.SIMILAR)
    for a, b, s, o in zip(i.tolist(), j.tolist(), sure.tolist(), is_open.tolist()):
        assert not (s and o) and (o or s == edit_similar(texts[a], texts[b]))
    assert is_open.sum() < len(i) / 4


def test_digests_tell_lines_apart():
    """Polynomial hashes modulo 2 ** 64 can't tell a Thue-Morse word from its complement, digests can."""
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(2048))
    other = word.translate(str.maketrans("ab", "ba"))
    assert L.digest(word.encode()) != L.digest(other.encode())


def brute(rows):
    """Kept texts by the definition: equal lines, and similar ones that share a key and are near in their SimHashes, are linked; the first of each group stays."""
    key = lambda r: (2**63 - 1 if r[0] is None else r[0], L.row_key(r[0], (r[1] or "").encode()))
    occ = [(key(r), n, x, i) for i, r in enumerate(rows) for n, line in enumerate((r[1] or "").split("\n")) if (x := normal(line))]
    occ.sort(key=lambda o: o[:2])
    keys = {x: set(L.line_keys([x.encode()])[0].tolist()) for _, _, x, _ in occ}
    prints = {x: int.from_bytes(L.simhashes([x.encode()])[0].tobytes()) for x in keys}
    up = list(range(len(occ)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(occ)):
        for b in range(a):
            x, y = occ[a][2], occ[b][2]
            if root(a) != root(b) and (x == y or (keys[x] & keys[y] and (prints[x] ^ prints[y]).bit_count() <= L.RADIUS * (1 + (min(len(x), len(y)) <= L.SHORT)) and edit_similar(x, y))):
                p, q = sorted((root(a), root(b)))
                up[q] = p
    gone = {(o[3], o[1]) for n, o in enumerate(occ) if o[:2] != occ[root(n)][:2]}
    return [(d, t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)) for i, (d, t) in enumerate(rows)]


def fixture():
    rng = random.Random(6)
    vocab = ["".join(rng.choices("abcdefgé", k=rng.randint(2, 7))) for _ in range(90)]
    base = [" ".join(rng.choices(vocab, k=rng.choice([1, 2, 4, 7, 12, 25]))) for _ in range(14)]
    rows = []
    for i in range(45):
        out = []
        for _ in range(rng.randint(0, 4)):
            w = rng.choice(base).split()
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w[k] = w[k][:-1] + rng.choice("xyz")
            x = " ".join(w)
            out.append(rng.choice([x, x, x.upper(), "  " + x + "!", ""]))
        rows.append((i, "\n".join(out)))
    return rows + [(100, None), (101, ""), (102, "...\n\n..."), (None, rows[2][1]), (3, rows[3][1]), (5, "same id other text"), (103, "long line " * 20000 + "\nend")]


def test_against_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, row string").selectExpr("*", "1 AS gone")
    for tile in (L.TILE, 2):
        got = L.deduplicate(df, tile=tile)
        assert got.columns == ["doc_id", "text", "row", "gone", "n_lines", "n_removed"]  # the clashing names stay
        have = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
        assert have == sorted(brute(rows), key=str), tile


def test_ids_that_collide(spark, monkeypatch):
    """Lines whose digests agree in the half that names links stay apart: one of them may go unlinked, none goes with a line unlike it."""
    whole = L.digest
    monkeypatch.setattr(L, "digest", lambda x: b"\0" * 8 + whole(x)[8:])
    lines = ["the quick brown fox jumps over the lazy dog", "pack my box with five dozen liquor jugs now", "the quick brown fox jumps over the lazy dogs"]
    nodes = {x: L.digest(x.encode()) for x in lines}
    seen = L.occurrences(spark.createDataFrame(list(enumerate([*lines, lines[1]])), "doc_id long, text string"))
    assert {bytes(r.node) for r in seen.collect()} == set(nodes.values())
    got = L.deduplicate(spark.createDataFrame(list(enumerate([*lines, lines[1]])), "doc_id long, text string"))
    assert {r.doc_id: r.n_removed for r in got.collect()} == {0: 0, 1: 0, 2: 0, 3: 1}


def test_keys_travel_in_packs(spark):
    """Every id of a key but its least one is found once, also by the way of large keys; a task sends packs of keys, not a row for each."""
    rng = random.Random(4)
    lines = [(rng.randrange(-(1 << 63), 1 << 63), [rng.choice([7, -8, rng.randrange(400) << 54]) for _ in range(L.BANDS)]) for _ in range(300)]
    rows = [(i.to_bytes(8, "big", signed=True) + b"\0" * 8, np.array(keys, np.int64).tobytes()) for i, keys in lines + lines[:40]]
    df = spark.createDataFrame(rows, "node binary, keys binary").repartition(3)
    ids = {k: {i for i, keys in lines if k in keys} for k in {k for _, keys in lines for k in keys}}
    want = sorted((k, min(some), i) for k, some in ids.items() for i in some if i != min(some))
    for most in (L.HOT, 50):  # no key is large, or the two frequent ones are
        assert sorted(map(tuple, L.shared_keys(df, most, sample=1).collect())) == want, most
    few = df.mapInArrow(L._packed(5, None), "bucket int, keys binary, ids binary").collect()
    assert len(few) <= 3 * 5 and sum(len(r["keys"]) for r in few) == sum(len(r["ids"]) for r in few) == 8 * L.BANDS * len(rows)


def test_hot_key_in_tiles(spark):
    """Two families of lines under one key, one far larger: dealt over tiles, both become one group each."""
    rng = random.Random(1)
    lines = {i: "".join(rng.choices("abcdefgh", k=40)) for i in (0, 1)}
    rows = [(7, i, i if i % 9 else 100, ("x" * 10 + str(i) + lines[i % 9 == 0]).encode()) for i in range(60)]
    rows = [(k, 500 if lab == i and i % 9 and i > 8 else lab, i, x) for k, i, lab, x in rows]
    rows = [(*r[:3], x.tobytes(), r[3]) for r, x in zip(rows, L.simhashes([r[3] for r in rows]))]
    df = spark.createDataFrame(rows, "key long, label long, id long, fp binary, line binary")
    for tile in (1000, 4):
        links = L._dealt(df, tile).repartition(3, "part").sortWithinPartitions("part").mapInArrow(L._across(0.8, L.BITS), "a long, b long").collect()
        up = {r[1]: r[1] for r in rows}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for _, label, i, *_ in rows:
            up.setdefault(i, i)
            up[root(i)] = root(label)
        for r in links:
            up[root(r.a)] = root(r.b)
        assert len({root(i) for _, _, i, *_ in rows}) == 2, tile


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.deduplicate(df).count() == 0
