"""Benchmark decontamination with a distributed positional inverted index.

The index is sharded by document: a row holds one document's postings, its terms with their word positions, for the
terms that any test item uses (no other term can take part in a match). It is stored once and then searched: for each
window of a test item, the offset-adjusted position lists are intersected from the term that is rarest in the whole
corpus upwards, so that nearly all candidates end at the first or second list. Windows travel to the shards, not
postings to the windows: nothing is shuffled, and a passage that half the corpus shares costs each shard only its own
part. Test items travel in blocks of at most ITEM_BYTES, so what is broadcast is bounded however many there are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, map_batches, materialize, text_bytes
from .words import words

WINDOW = 13
#: Bytes of test items that are sent to the executors at a time.
ITEM_BYTES = 16 << 20
#: Words by which a proximity match may be longer than its window.
SLOP = 3

_INDEX = "doc_id long, n_words long, terms array<int>, counts array<int>, positions array<int>"


def windows_of(item_words: list, size: int = WINDOW) -> list[tuple]:
    """Windows of `size` consecutive words; one of all words if there are fewer; none without words."""
    n = len(item_words)
    return [tuple(item_words[i : i + size]) for i in range(max(1, n - size + 1))] if n else []


def positional_index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings of each document: terms ascending, how often each occurs, and their positions term by term."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, terms, counts, positions = [], [], [], []
        get = vocabulary.get
        for text in text_bytes(column(batch, "text")):
            w = words(text)
            ids = np.fromiter((get(x, -1) for x in w), np.int32, len(w))
            at = np.flatnonzero(ids >= 0).astype(np.int32)
            order = np.argsort(ids[at], kind="stable")
            at = at[order]
            kinds, n = np.unique(ids[at], return_counts=True)
            n_words.append(len(w)), terms.append(kinds), counts.append(n.astype(np.int32)), positions.append(at)

        def lists(parts: list[np.ndarray]) -> pa.Array:
            ends = np.r_[0, np.cumsum([len(x) for x in parts])].astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).astype(np.int32)))

        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(n_words, pa.int64()), lists(terms), lists(counts), lists(positions)], names=["doc_id", "n_words", "terms", "counts", "positions"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), work, _INDEX, "text")


def term_counts(index: DataFrame, size: int) -> np.ndarray:
    """Occurrences of each term in the whole corpus: one row per task and term, summed; the result is as long as the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            terms, counts = (column(b, c).flatten().to_numpy(zero_copy_only=False) for c in ("terms", "counts"))
            total += np.bincount(terms, weights=counts, minlength=size).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    for row in index.select("terms", "counts").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row.term] = row.n
    return out


class Plan:
    """Windows by their rarest term: (offset of it, other terms as (term, offset) from the rarest on, window number)."""

    def __init__(self, windows: dict[tuple[int, ...], list[int]], freq: np.ndarray):
        self.items, self.sizes = list(windows.values()), [len(w) for w in windows]
        self.by_term: dict[int, list] = defaultdict(list)
        for number, w in enumerate(windows):
            order = sorted(range(len(w)), key=lambda i: (freq[w[i]], w[i], i))
            self.by_term[w[order[0]]].append((order[0], [(w[i], i) for i in order[1:]], number))
        self.rare = np.array(sorted(self.by_term), np.int32)


def _exact(post: dict[int, np.ndarray], starts: np.ndarray, rest: list[tuple[int, int]]) -> np.ndarray:
    for term, offset in rest:
        have = post[term] - offset
        at = np.searchsorted(have, starts)
        at[at == len(have)] = 0
        starts = starts[have[at] == starts]
        if not len(starts):
            break
    return starts


def _near(post: dict[int, np.ndarray], anchor: np.ndarray, first: int, rest: list[tuple[int, int]], width: int) -> bool:
    """Whether all terms, each as often as the window has it, stand within `width` consecutive words."""
    need: dict[int, int] = defaultdict(int)
    for t in [first, *(t for t, _ in rest)]:
        need[t] += 1
    for p in anchor.tolist():
        near, ok = [], True
        for t, n in need.items():
            a = post[t]
            lo, hi = np.searchsorted(a, p - width + 1), np.searchsorted(a, p + width)
            if hi - lo < n:
                ok = False
                break
            near += [(x, t) for x in a[lo:hi].tolist()]
        if not ok:
            continue
        near.sort()
        have: dict[int, int] = defaultdict(int)
        met, lo = 0, 0
        for x, t in near:
            have[t] += 1
            met += have[t] == need[t]
            while near[lo][0] <= x - width:
                u = near[lo][1]
                met -= have[u] == need[u]
                have[u] -= 1
                lo += 1
            if met == len(need):
                return True
    return False


def _search(plan: Plan, slop: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, hits, items, near = [], [], [], []
            ids, n_words = column(b, "doc_id"), column(b, "n_words").to_pylist()
            flat = {c: (column(b, c).offsets.to_numpy(), column(b, c).values.to_numpy(zero_copy_only=False)) for c in ("terms", "counts", "positions")}
            for row in range(b.num_rows):
                terms, counts, positions = (v[o[row] : o[row + 1]] for o, v in (flat[c] for c in ("terms", "counts", "positions")))
                some = plan.rare[np.isin(plan.rare, terms, assume_unique=True)] if len(terms) else terms
                spans, found, close = [], set(), 0
                if len(some):
                    ends = np.cumsum(counts)
                    post = {t: positions[e - n : e] for t, n, e in zip(terms.tolist(), counts.tolist(), ends.tolist())}
                    for t in some.tolist():
                        for offset, rest, number in plan.by_term[t]:
                            if not all(u in post for u, _ in rest):
                                continue
                            starts = _exact(post, post[t] - offset, rest)
                            if len(starts):
                                spans += [(s, s + plan.sizes[number]) for s in starts.tolist()]
                                found.update(plan.items[number])
                            elif slop is not None:
                                close += _near(post, post[t], t, rest, plan.sizes[number] + slop)
                merged: list[list[int]] = []
                for s, e in sorted(spans):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(e, merged[-1][1])
                    else:
                        merged.append([s, e])
                docs.append(n_words[row]), hits.append([{"start": s, "end": e} for s, e in merged]), items.append(sorted(found)), near.append(close)
            yield pa.RecordBatch.from_arrays([ids, pa.array(docs, pa.int64()), pa.array(hits, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(items, pa.list_(pa.int64())), pa.array(near, pa.int64())], names=["doc_id", "n_words", "hits", "items", "n_near"])

    return run


def _blocks(items: DataFrame, item_id: str, item_text: str, most: int) -> list[DataFrame]:
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // most))
    return [rows] if n == 1 else [rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, slop: int | None = SLOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(doc_id, n_words, hits, items, n_near) of every document.

    hits: merged word spans [start, end) inside an exact occurrence of a window of any item; items: ids of the items
    with such windows, ascending; n_near: windows found only in proximity, all their words within size + slop words.
    Null texts have no words, items without words no window; an item without an id hits words but isn't listed.
    Documents with the same id are one row each, repeated rows too, and an empty table gives an empty one. Other columns of
    either table are not looked at, whatever their names. A text of any length is one row of the index.
    """
    blocks = _blocks(items, item_id, item_text, item_bytes)
    if len(blocks) == 1:
        return _contamination(docs, blocks[0], id_col, text_col, size, slop)
    keyed = materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), "rows")
    parts = [materialize(_contamination(keyed, b, "row", "text", size, slop), "block") for b in blocks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    found = out.groupBy("doc_id").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.sum("n_near").alias("n_near"))
    merged = F.expr("""aggregate(array_sort(hits), cast(array() as array<struct<start:int,end:int>>), (a, x) -> CASE WHEN size(a) > 0 AND x.start <= element_at(a, -1).end
        THEN concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(x.end, element_at(a, -1).end)))) ELSE concat(a, array(x)) END)""")
    found = found.select(F.col("doc_id").alias("row"), "n_words", merged.alias("hits"), "items", "n_near")
    return keyed.select("row", "doc_id").join(found, "row").drop("row")


def _contamination(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, size: int, slop: int | None) -> DataFrame:
    rows = [(r.item_id, windows_of(words(r.text.encode()), size)) for r in items.toLocalIterator()]  # a block: bounded
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in rows for x in ws for w in x}))}
    windows: dict[tuple[int, ...], list[int]] = {}
    for item, ws in rows:
        for w in ws:
            ids = windows.setdefault(tuple(vocabulary[x] for x in w), [])
            if item is not None and item not in ids:
                ids.append(item)
    index = materialize(positional_index(docs, vocabulary, id_col, text_col), "index")
    plan = Plan(windows, term_counts(index, len(vocabulary)))
    return index.mapInArrow(_search(plan, slop), "doc_id long, n_words long, hits array<struct<start:int,end:int>>, items array<long>, n_near long")


def verdict(found: DataFrame) -> DataFrame:
    """n_hit (words within hits) and contaminated (at least one word in twenty is hit) beside the columns of contamination()."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["end"] - h["start"])
    found = found.withColumn("n_hit", n_hit)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that aren't contaminated. Rows that share an id go together; rows without one can't be named by a verdict and stay."""
    id_col, text_col = options.pop("id_col", "doc_id"), options.pop("text_col", "text")
    bad = verdict(contamination(docs.where(F.col(id_col).isNotNull()), items, id_col, text_col, **options)).where("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs[id_col].cast("long") == bad["_bad"], "left_anti")
