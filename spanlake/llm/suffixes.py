"""Suffix-array deduplication: remove every byte that a WINDOW-byte string covers which also starts anywhere else.

Equal windows have equal content-defined anchors at equal places, so the suffixes that need sorting are those whose
anchor's gram occurs more than once. Anchors fall into classes of equal context (the bytes of all windows that share the
anchor). Classes are counted with map-side combine: thousands of copies are one class, all of whose windows repeat.
Classes that share a gram but not their context have their suffixes compared: sampled splitters range-partition
them by the leading bytes at the anchor, each bucket sorts its windows by multikey quicksort (eight bytes at a time,
equal runs only), and runs of equal windows are marked. The splitters lie between grams, and equal windows have one
gram, so no run crosses a bucket's bounds; a gram with very many classes is dealt over all tasks window by window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors, bloom
from .common import bound_batches, by_bytes, column, map_batches, on_disk, partitions, text_buffers

WINDOW, GRAM = anchors.WINDOW, anchors.GRAM
#: Classes of one gram beyond which its windows are dealt out one by one.
HOT_CLASSES = 1000
#: Windows that a bucket sorts at a time (whole grams, so at least one), and bits of the filters that spare traffic.
SORTED_AT_ONCE, FILTER_BITS = 300_000, 1 << 23
_CHUNK, _SPANS = 2 << 20, "array<struct<start:bigint,end:bigint>>"


def _docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _row_keys(ids: list, data: bytes, ends: list[int]) -> np.ndarray:
    """A key of each row by id and text, so that rows that share an id but not their text are told apart."""
    return np.fromiter((xxhash.xxh3_64_intdigest(data[a:b], i & (2**64 - 1) if i is not None else 2**63 + 1) for i, a, b in zip(ids, ends, ends[1:])), np.uint64, len(ids)).view(np.int64)


def _contexts(data: bytes, a: anchors.Anchors, window: int) -> np.ndarray:
    """Hash of the context of each anchor and of the anchor's place in it."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(data[x : y + window], z - x) for x, y, z in zip(a.first.tolist(), a.last.tolist(), a.at.tolist())), np.uint64, len(a.at)).view(np.int64)


def equal_windows(data: np.ndarray, starts: np.ndarray, label: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which of the windows that begin at `starts` equal another one of the same label.

    Multikey quicksort, eight bytes a key: the windows are sorted by the next eight bytes, split into runs that agree
    so far, and runs of one are done with.
    """
    data = np.r_[data, np.zeros(8, np.uint8)]
    live = np.arange(len(starts))
    for at in [-1, *range(0, window, 8)]:
        if not len(live):
            break
        if at < 0:
            order = np.argsort(label[live], kind="stable")
            live, run = live[order], label[live][order]
            new = np.r_[True, run[1:] != run[:-1]]
        else:
            place = starts[live] + min(at, window - 8) if window >= 8 else starts[live]
            width = min(8, window)
            value = np.zeros((len(live), 8), np.uint8)
            for k in range(width):
                value[:, k] = data[place + k]
            value = value.view(">u8").ravel().astype(np.uint64)
            order = np.lexsort((value, run))
            live, run, value = live[order], run[order], value[order]
            new = np.r_[True, (run[1:] != run[:-1]) | (value[1:] != value[:-1])]
        number = np.cumsum(new)
        many = np.bincount(number)[number] > 1
        live, run = live[many], number[many]
    out = np.zeros(len(starts), bool)
    out[live] = True
    return out


def _runs(marked: np.ndarray, cls: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, first shift, last shift) of runs of marked windows; windows lie in the order of class and shift."""
    at = np.flatnonzero(marked)
    if not len(at):
        return at, at, at
    new = np.r_[True, (at[1:] != at[:-1] + 1) | (cls[at[1:]] != cls[at[:-1]])]
    first = at[new]
    last = at[np.r_[np.flatnonzero(new)[1:] - 1, len(at) - 1]]
    return cls[first], shift[first], shift[last]


def _bucket(window: int, most: int):
    """Of classes (gram, ctx, left, form) that come sorted by gram: runs of repeated windows, by their shift from the anchor."""

    def flush(parts: list[tuple]) -> pa.RecordBatch | None:
        gram, ctx, left = (np.concatenate([p[i] for p in parts]) for i in range(3))
        sizes = np.concatenate([p[3] for p in parts])
        data = np.concatenate([p[4] for p in parts])
        begin = np.r_[0, np.cumsum(sizes)]
        n_win = sizes - window + 1
        cls = np.repeat(np.arange(len(gram)), n_win)
        within = np.arange(len(cls)) - np.repeat(np.r_[0, np.cumsum(n_win)][:-1], n_win)
        group = np.cumsum(np.r_[True, gram[1:] != gram[:-1]])
        label = group[cls] * (2 * window) + within - left[cls] + window
        marked = equal_windows(data, begin[cls] + within, label, window)
        c, lo, hi = _runs(marked, cls, within - left[cls])
        if not len(c):
            return None
        return pa.RecordBatch.from_arrays([pa.array(gram[c]), pa.array(ctx[c]), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["gram", "ctx", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, last = [], 0, None
        for batch in by_bytes(batches, "form", _CHUNK):
            gram, ctx = (column(batch, c).to_numpy() for c in ("gram", "ctx"))
            left = column(batch, "left").to_numpy().astype(np.int64)
            off, raw = text_buffers(column(batch, "form"))
            cut = 0
            while cut < len(gram):
                # a flush waits for the end of a gram
                if count >= most and gram[cut] != last:
                    if (found := flush(held)) is not None:
                        yield found
                    held, count = [], 0
                room = np.cumsum(np.diff(off)[cut:] - window + 1) + count
                stop = cut + int(np.searchsorted(room, most)) + 1
                same = np.flatnonzero(gram[min(stop, len(gram)) - 1 :] != gram[min(stop, len(gram)) - 1])
                stop = min(stop, len(gram)) - 1 + int(same[0]) if len(same) else len(gram)
                held.append((gram[cut:stop], ctx[cut:stop], left[cut:stop], np.diff(off[cut : stop + 1]), raw[off[cut] : off[stop]].copy()))
                count += int((np.diff(off[cut : stop + 1]) - window + 1).sum())
                last, cut = gram[stop - 1], stop
        if held and (found := flush(held)) is not None:
            yield found

    return run


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, hot: int = HOT_CLASSES, most: int = SORTED_AT_ONCE, bits: int = FILTER_BITS) -> DataFrame:
    """(row, start, end): bytes of the row with that key that windows cover which also start elsewhere; spans may overlap."""
    plain = _docs(docs, id_col, text_col)

    def grams(batch: pa.RecordBatch) -> pa.RecordBatch:
        off, raw = text_buffers(column(batch, "text"))
        a = anchors.find(raw, off, window, gram)
        return pa.RecordBatch.from_arrays([pa.array(a.gram), pa.array(_contexts(raw.tobytes(), a, window))], names=["gram", "ctx"])

    per_class = map_batches(plain.select("text"), grams, "gram long, ctx long", "text", _CHUNK).groupBy("gram", "ctx").agg(F.count(F.lit(1)).alias("n"))
    seen = per_class.groupBy("gram").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("classes")).where("n > 1")
    seen = on_disk(seen)
    repeated, mixed = bloom.build(seen, "gram", bits), bloom.build(seen.where("classes > 1"), "gram", bits)
    seen.unpersist()

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for batch in by_bytes(batches, "text", _CHUNK):
            off, raw = text_buffers(column(batch, "text"))
            data = raw.tobytes()
            a = anchors.find(raw, off, window, gram)
            a = anchors.Anchors(*[x[bloom.contains(repeated, a.gram)] for x in a])
            if not len(a.at):
                continue
            ctx = _contexts(data, a, window)
            rows = _row_keys(column(batch, "doc_id").to_pylist(), data, off.tolist())[a.text]
            forms: list[bytes | None] = [None] * len(ctx)
            for i in np.flatnonzero(bloom.contains(mixed, a.gram)).tolist():
                key = (int(a.gram[i]), int(ctx[i]))
                if key not in sent:  # once in a task; a class's context is the same everywhere
                    forms[i] = data[int(a.first[i]) : int(a.last[i]) + window]
                    sent.add(key)
            if len(sent) > 500_000:
                sent.clear()
            place = a.at - off[a.text]
            cols = [pa.array(a.gram), pa.array(ctx), pa.array(rows), pa.array(place), pa.array((a.at - a.first).astype(np.int32)), pa.array((a.last - a.at).astype(np.int32)), pa.array(forms, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["gram", "ctx", "row", "at", "left", "right", "form"])

    bound_batches(docs.sparkSession)
    found = on_disk(plain.mapInArrow(places, "gram long, ctx long, row long, at long, left int, right int, form binary"))
    classes = found.groupBy("gram", "ctx").agg(F.count(F.lit(1)).alias("n"), F.min("left").alias("left"), F.min("right").alias("right"))
    whole = classes.where("n > 1").select("gram", "ctx", F.col("left").alias("l"), F.col("right").alias("r")).select("gram", "ctx", (-F.col("l")).alias("lo"), F.col("r").alias("hi"))
    forms = found.where("form IS NOT NULL").select("gram", "ctx", "left", "form").groupBy("gram", "ctx").agg(F.min("left").alias("left"), F.min("form").alias("form"))
    forms = on_disk(forms)
    crowded = on_disk(forms.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("gram"))
    cold = forms if crowded.isEmpty() else forms.join(crowded, "gram", "left_anti")
    lead = F.conv(F.hex(F.substring("form", F.col("left") + 1, F.lit(7))), 16, 10).cast("long")
    cold = cold.select(lead.alias("lead"), "gram", "ctx", "left", "form").repartitionByRange(partitions(docs.sparkSession), "lead", "gram").sortWithinPartitions("lead", "gram")
    partial = cold.mapInArrow(_bucket(window, most), "gram long, ctx long, lo int, hi int")
    if not crowded.isEmpty():
        partial = partial.unionByName(_one_by_one(forms.join(crowded, "gram", "left_semi"), window))
    verdict = on_disk(whole.unionByName(partial))
    hits = found.select("gram", "ctx", "row", "at").join(verdict, ["gram", "ctx"])
    return hits.select("row", (F.col("at") + F.col("lo")).alias("start"), (F.col("at") + F.col("hi") + window).alias("end"))


def _one_by_one(forms: DataFrame, window: int) -> DataFrame:
    """Repeated windows of crowded grams: each window is a row of its own, grouped by its 128-bit digest with map-side combine."""

    def explode(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for g, c, left, form in zip(*(column(batch, x).to_pylist() for x in ("gram", "ctx", "left", "form"))):
            for j in range(len(form) - window + 1):
                rows.append((g, c, j - left, xxhash.xxh3_128_digest(form[j : j + window])))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=["gram", "ctx", "shift", "digest"])

    windows = on_disk(map_batches(forms, explode, "gram long, ctx long, shift int, digest binary", "form", 1 << 18))
    twice = windows.groupBy("gram", "shift", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    found = windows.join(on_disk(twice), ["gram", "shift", "digest"])
    return found.select("gram", "ctx", F.col("shift").alias("lo"), F.col("shift").alias("hi"))


def union_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union; runs that touch are one."""
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.r_[True, s[1:] > e[:-1]] if len(s) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return s[first], e[np.r_[first[1:] - 1, len(s) - 1]] if len(s) else e


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, bits: int = FILTER_BITS, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of each row.

    spans: maximal removed byte runs (start, end); kept: the remaining bytes, which need not be UTF-8. A null text is an
    empty one. Rows that share an id are judged each by its own text; a repeated row is a copy like any other. Texts
    without a repeat stay where they are, but for the false hits of a filter of fixed size.
    """
    spans = on_disk(repeats(docs, id_col, text_col, window, gram, bits=bits, **options))
    merged = spans.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
    has = bloom.build(spans.select("row").distinct(), "row", bits)

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        off, raw = text_buffers(column(batch, "text"))
        data, ends = raw.tobytes(), off.tolist()
        rows = _row_keys(column(batch, "doc_id").to_pylist(), data, ends)
        moves = bloom.contains(has, rows).tolist()
        parts = [data[a:b] for a, b in zip(ends, ends[1:])]
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(rows), pa.array(parts, pa.binary()), pa.array(moves)], names=["doc_id", "row", "data", "moves"])

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        off, raw = text_buffers(column(batch, "data"))
        data, ends = raw.tobytes(), off.tolist()
        removed, runs, kept = [], [], []
        for a, b, spans in zip(ends, ends[1:], column(batch, "spans").to_pylist()):
            s, e = union_spans(np.array([x["start"] for x in spans or []], np.int64), np.array([x["end"] for x in spans or []], np.int64))
            edges = [0, *np.column_stack([s, e]).ravel().tolist(), b - a]
            kept.append(b"".join(data[a + x : a + y] for x, y in zip(edges[::2], edges[1::2])))
            removed.append(b - a - len(kept[-1]))
            runs.append([{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist())])
        sizes = pa.array(np.diff(off))
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), sizes, pa.array(removed, pa.int64()), pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    rows = map_batches(_docs(docs, id_col, text_col), split, "doc_id long, row long, data binary, moves boolean", "text", _CHUNK)
    still = rows.where("NOT moves").select("doc_id", F.octet_length("data").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.array().cast(_SPANS).alias("spans"), F.col("data").alias("kept"))
    moved = rows.where("moves").join(merged, "row", "left").select("doc_id", "data", "spans")
    return still.unionByName(map_batches(moved, cut, f"doc_id long, n_bytes long, n_removed long, spans {_SPANS}, kept binary", "data", _CHUNK))


def report(docs: DataFrame, **options) -> DataFrame:
    """deduplicate() with the digest of the kept bytes in their place."""
    found = deduplicate(docs, **options)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
