import random
from collections import defaultdict

import xxhash

from spanlake.llm import simhash
from spanlake.llm.components import connected_components


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    ids = list(fps)
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: root(i) for i in ids}


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in texts.items()], "doc_id long, text string, fp string, key int")


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=200)) for _ in range(12)]
    texts = {}
    for i in range(160):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            w[rng.randrange(len(w))] = rng.choice(words)
        texts[i] = " ".join(w)
    texts |= {200: None, 201: "", 202: " \t\n", 203: "One", 204: "one", 205: "ÉCOLE Été", 206: "a b", 207: "long " * 40000, 208: "x\x0by"}
    fps = {i: brute_fp(t) for i, t in texts.items()}
    want = brute_components(fps)
    got = {r.doc_id: (r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    assert got == {i: (fps[i], want[i]) for i in texts}
    kept = sorted(r.doc_id for r in simhash.survivors(docs_of(spark, texts)).collect())
    assert kept == sorted(set(want.values()))


def test_hot_keys_are_split_without_losing_links(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 260:
        x = centre
        for b in rng.sample(range(8), rng.choice([1, 2, 3, 4])) + rng.sample(range(64), rng.choice([0, 1])):
            x ^= 1 << b
        fps.add(x)
        if len(fps) > 180:
            fps.add(rng.getrandbits(64))
    fps = sorted(fps)
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    want = brute_components(dict(zip(signed, fps)))
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for tile in (8, 4096):
        comp = {r.node: r.root for r in connected_components(simhash.hamming_links(df, tile=tile)).collect()}
        groups, expect = defaultdict(set), defaultdict(set)
        for x in signed:
            groups[comp.get(x, x)].add(x)
            expect[want[x]].add(x)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_empty_table_null_ids_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    df = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (None, "zz")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(df).collect() if r.component_id)
    assert got == [(-1, 5), (5, 5), (5, 5)]
    assert simhash.near_duplicates(df).count() == 4


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 300)] + [(900, 900), (None, 3), (1000, 999)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {i: 1 for i in range(1, 301)} | {999: 999, 1000: 999}
