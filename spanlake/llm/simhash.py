"""SimHash near-duplicates: exact links between fingerprints by tiled exclusive-or and bit counts.

Fingerprints within `radius` bits agree in at least `blocks - radius` of `blocks` equal parts, so each choice of that
many parts is a table in which they share a key. The tiles of a key hold fingerprints of one bit count; tile pairs
whose bit counts differ by more than the radius are skipped, the others are compared in full with numpy. Nothing is
approximate. A key with very many fingerprints is dealt over many tasks, one per tile pair, and each task returns a
spanning forest of its links rather than all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, map_batches, materialize, text_bytes
from .components import connected_components

SHINGLE, SEED, RADIUS, BLOCKS = 3, 42, 2, 4
#: Fingerprints of one key and bit count that one task compares with those of another; beyond that, they are split.
TILE = 4096
_SAMPLE = 16


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """64-bit SimHash of the k-word shingles of UTF-8 `text`, ASCII lower-cased, words between ASCII white space.

    A text of fewer words is one shingle; a text of none has fingerprint 0. A bit is set if over half the hashes set it.
    """
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if n <= k:
        return digest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    spans = zip((ends - sizes)[: n - k + 1].tolist(), ends[k - 1 :].tolist())
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n - k + 1)
    ones = np.zeros(64, np.float64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        ones += np.ones(len(bits), np.float32) @ bits
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for each row; fp holds the 64 bits as a signed long. A null text has no words."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.fromiter((fingerprint(x, k) for x in text_bytes(column(batch, "text"))), np.uint64, batch.num_rows)
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), work, "doc_id long, fp long", "text")


class Forest:
    """Union-find over positions 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def tile_links(left: np.ndarray, right: np.ndarray, radius: int, same: bool, step: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of a spanning forest of the links between two arrays of fingerprints sorted by bit count."""
    forest = Forest(len(left) if same else len(left) + len(right))
    shift = 0 if same else len(left)
    lc, rc = np.bitwise_count(left), np.bitwise_count(right)
    out: list[tuple[int, int]] = []
    for i in range(0, len(left), step):
        for j in range(i if same else 0, len(right), step):
            if int(rc[j]) - int(lc[min(i + step, len(left)) - 1]) > radius or int(lc[i]) - int(rc[min(j + step, len(right)) - 1]) > radius:
                continue
            close = np.bitwise_count(left[i : i + step, None] ^ right[None, j : j + step]) <= radius
            if same and i == j:
                close = np.triu(close, 1)
            for a, b in zip(*(x.tolist() for x in np.nonzero(close))):
                if forest.join(i + a, shift + j + b):
                    out.append((i + a, j + b))
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _compare(radius: int):
    """Of rows (key, side, fp) sorted by key: links within each key. side 0 is a group of its own, 1 and 2 are two tiles to be held against each other."""
    names = ["a", "b"]

    def batch_of(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=names)

    def flush(side: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((fp, np.bitwise_count(fp)))
        side, fp = side[order], fp[order]
        if not side.any():
            i, j = tile_links(fp, fp, radius, True)
            return fp[i], fp[j]
        left, right = fp[side == 1], fp[side == 2]
        i, j = tile_links(left, right, radius, False)
        return left[i], right[j]

    def whole(key: np.ndarray, side: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Links of complete keys. Keys of one row have none; those of two, by far the most of the rest, are compared all at once."""
        cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[cuts, len(key)])
        two = cuts[sizes == 2]
        near = two[(np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius) & ((side[two] == 0) | (side[two] != side[two + 1]))] if len(two) else two
        if len(near):
            yield batch_of(fp[near], fp[near + 1])
        for s, n in zip(cuts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            a, b = flush(side[s : s + n], fp[s : s + n])
            if len(a):
                yield batch_of(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            key, side, fp = (column(batch, c).to_numpy(zero_copy_only=False) for c in ("key", "side", "fp"))
            if not len(key):
                continue
            # the last key may go on in the next batch
            cut = int(np.searchsorted(key, key[-1])) if key[0] <= key[-1] else len(key) - 1
            if cut:
                parts = [*held, (key[:cut], side[:cut], fp[:cut])]
                k, d, f = (np.concatenate(x) for x in zip(*parts))
                yield from whole(k, d, f.view(np.uint64))
                held = []
            held.append((key[cut:], side[cut:], fp[cut:]))
        if held:
            k, d, f = (np.concatenate(x) for x in zip(*held))
            yield from whole(k, d, f.view(np.uint64))

    return run


def hamming_links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct `fp` (long) at `radius` or fewer differing bits."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("blocks must exceed the radius")
    kept = list(combinations(range(blocks), blocks - radius))
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    part = [F.shiftrightunsigned("fp", lo).bitwiseAND((1 << hi - lo) - 1) for lo, hi in zip(cuts, cuts[1:])]
    keys = F.array(*[F.xxhash64(F.lit(n), *[part[i] for i in chosen]) for n, chosen in enumerate(kept)])
    rows = fps.select("fp", F.bit_count("fp").cast("int").alias("ones"), F.explode(keys).alias("key"))
    # hot keys, found in a sixteenth of the fingerprints (which keys are split has no bearing on the links): by bit count, how
    # many tiles each needs; few rows, but they may grow, so they are joined and not collected
    some = rows.where(F.pmod(F.xxhash64("fp"), F.lit(_SAMPLE)) == 0).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * _SAMPLE > 2 * tile).select("key") if tile >= 16 * _SAMPLE else rows.select("key").distinct()
    some = materialize(some, "sampled", small=True)
    if some.isEmpty():
        cold = rows.select("key", F.lit(0).alias("side"), "fp")
        return cold.repartition("key").sortWithinPartitions("key").mapInArrow(_compare(radius), "a long, b long")
    per = rows.join(some, "key", "left_semi").groupBy("key", "ones").agg(F.count(F.lit(1)).alias("n"))
    hot = per.groupBy("key").agg(F.sum("n").alias("all"), F.collect_list(F.struct("ones", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))).alias("have")).where(F.col("all") > 2 * tile)
    hot = materialize(hot.select("key", "have"), "hot", small=True)
    cold = rows.join(hot, "key", "left_anti").select("key", F.lit(0).alias("side"), "fp")
    mine = F.expr("filter(have, h -> h.ones = ones)[0].tiles")
    dealt = rows.join(hot, "key").withColumn("t", F.pmod(F.xxhash64("fp"), mine).cast("int"))
    others = F.expr(f"flatten(transform(filter(have, h -> abs(h.ones - ones) <= {radius}), h -> transform(sequence(0, h.tiles - 1), i -> struct(h.ones AS o, i AS i))))")
    dealt = dealt.select("fp", "key", "ones", "t", F.explode(others).alias("w"))
    first = F.struct(F.least(F.struct("ones", "t"), F.struct(F.col("w.o").alias("ones"), F.col("w.i").alias("t"))).alias("x"), F.greatest(F.struct("ones", "t"), F.struct(F.col("w.o").alias("ones"), F.col("w.i").alias("t"))).alias("y"))
    dealt = dealt.withColumn("pair", first)
    own = F.struct("ones", "t")
    side = F.when(F.col("pair.x") == F.col("pair.y"), 0).when(own == F.col("pair.x"), 1).otherwise(2)
    dealt = dealt.select(F.xxhash64("key", "pair").alias("key"), side.alias("side"), "fp")
    return cold.unionByName(dealt).repartition("key").sortWithinPartitions("key").mapInArrow(_compare(radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, k: int = SHINGLE, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id) for each row of `docs`: component_id is the least id linked to it, itself included.

    Equal fingerprints are one node, so copies are never paired. Null or empty texts have fingerprint 0 and link like
    others; null ids are never a component_id unless a component has no other id; repeated rows come back as often.
    Other columns are not looked at, whatever their names, and an empty table gives an empty one.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, k), "fps")
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes", small=True)
    found = connected_components(hamming_links(nodes.select("fp"), radius, blocks, tile))
    rooted = nodes.join(found, nodes.fp == found.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "rooted", small=True)
    least = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least", small=True)
    classes = materialize(rooted.join(least, "root").select("fp", "component_id"), "classes", small=True)
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` without those that another document stands for: of each component, the one with its least id stays.

    Rows that share an id stay or go together; rows without an id stay.
    """
    found = near_duplicates(docs, id_col, text_col, **options).where("doc_id IS NOT NULL")
    gone = found.groupBy(F.col("doc_id").alias("_gone")).agg(F.min(F.col("doc_id") != F.col("component_id")).alias("all")).where("all").select("_gone")
    gone = materialize(gone, "gone", small=True)
    return docs.join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")
