"""Span algebra: projection, overlaps, overlap resolution, inline markup, masking and recall, merging across chunks.

Spans are half-open code-point ranges. Folds whose next step depends on the last (greedy and longest-wins selection,
merging) run over rows that Spark has dealt by document and sorted, as one stream per task: linear, without a
collected group, and without a call per document. Masking works on one row per chunk, mentions nested.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..plans import stages

#: Fixed value: inline markup, [surface](LABEL).
ANNOTATION = r"\[([^\]\n]+)\]\(([^)\n]+)\)"
_annotation = re.compile(ANNOTATION)
#: Offsets of 0 and missing ones stand here in the order of mentions.
LAST = 10**12
#: Characters of a position bucket, within which overlaps are looked for.
BUCKET = 64


def project(mentions: DataFrame, chunks: DataFrame, keys: list[str], base: str = "char_start", chars: str | None = None) -> DataFrame:
    """global_start and global_end of chunk-local mentions; null where the chunk, or a local offset, is unknown.

    With `chars` (the chunks' column of lengths), a span outside its chunk fails the query.
    """
    side = chunks.select(*keys, F.col(base).alias("_base"), *([F.col(chars).alias("_chars")] if chars else []))
    out = mentions.join(side, keys, "left")
    known = F.col("_base").isNotNull() & F.col("start").isNotNull() & F.col("end").isNotNull()
    shift = lambda c: F.when(known, F.col("_base") + F.col(c))
    if chars:
        bad = known & ~((F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.col("_chars")))
        shift = lambda c: F.when(bad, F.raise_error(F.lit("span outside its chunk")).cast("long")).when(known, F.col("_base") + F.col(c))
    return out.withColumns({"global_start": shift("start"), "global_end": shift("end")}).drop("_base", "_chars")


#: Each level of bins is so many times as wide as the one below; there are as many as a long of characters needs.
_TIMES, _LEVELS = 8, 18


def _binned(spans: DataFrame, doc: str, key: str, width: int) -> DataFrame:
    """(doc, k, s, e, level): the lowest level on which a bin is as wide as the span."""
    s = spans.where(F.col("start") < F.col("end")).select(F.col(doc).alias("doc"), F.col(key).alias("k"), F.col("start").cast("long").alias("s"), F.col("end").cast("long").alias("e"))
    wide = " + ".join(f"if(e - s > {width}L * shiftleft(1L, {3 * i}), 1, 0)" for i in range(_LEVELS))
    return s.withColumn("level", F.expr(wide))


def _probes(binned: DataFrame, levels: Column, width: int) -> DataFrame:
    """A row for each bin in which a span that overlaps may begin, on its own level and those above that are in use: three a level at most."""
    size = lambda level: F.lit(width).cast("long") * F.call_function("shiftleft", F.lit(1).cast("long"), (level * 3).cast("int"))
    used = F.filter(F.col("_levels"), lambda x: x >= F.col("level"))
    bins = F.transform(used, lambda x: F.transform(F.sequence(F.floor((F.col("s") - size(x) + 1) / size(x)), F.floor((F.col("e") - 1) / size(x))), lambda b: F.struct(x.alias("at"), b.alias("bin"))))
    return binned.withColumn("_levels", levels).select("doc", "k", "s", "e", "level", F.explode(F.flatten(bins)).alias("p")).select("doc", "k", "s", "e", "level", F.col("p.at").alias("at"), F.col("p.bin").alias("bin"))


def overlap_pairs(spans: DataFrame, doc: str = "doc_id", key: str = "id", width: int = BUCKET) -> DataFrame:
    """(doc, a, b) of each two spans of a document that share a character, a < b.

    Bins are nested: a span is put in one bin, that of its begin on the level of its length, and looks for others in a few
    bins of its own level and of each wider one that is in use. So a long span costs no more rows than a short one, and a document's
    spans are never held against each other as a whole. Of two spans the shorter one's search finds the other; of two on one level, that of the greater key.
    """
    s = _binned(spans, doc, key, width)
    levels = s.agg(F.sort_array(F.collect_set("level")).alias("l")).scalar()
    size = F.expr(f"{width}L * shiftleft(1L, 3 * level)")
    home = s.select(F.col("doc").alias("_doc"), F.col("k").alias("_k"), F.col("s").alias("_s"), F.col("e").alias("_e"), F.col("level").alias("_level"), F.floor(F.col("s") / size).alias("_bin"))
    met = _probes(s, levels, width).join(home, (F.col("doc") == F.col("_doc")) & (F.col("at") == F.col("_level")) & (F.col("bin") == F.col("_bin")) & (F.col("s") < F.col("_e")) & (F.col("_s") < F.col("e")))
    met = met.where((F.col("level") < F.col("_level")) | (F.col("_k") < F.col("k")))
    return met.where("k != _k").select(F.col("doc").alias(doc), F.least("k", "_k").alias("a"), F.greatest("k", "_k").alias("b"))


def streamed(df: DataFrame, keys: list[str], order: list[Column], make: Callable[[], Callable], read: list[str]) -> DataFrame:
    """The rows of `df` that a fold keeps. Rows come dealt by `keys` and sorted within each; for each key, make() gives a
    function that takes the values `read` of a row and its number and returns which row numbers are settled as kept, or at
    the end (None) which of those held back are."""
    names = df.columns
    sort = [F.col(k) for k in keys] + order
    dealt = df.repartition(*keys).sortWithinPartitions(*sort)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, fold, held, base = None, None, None, 0
        kept: list[int] = []

        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            start = 0 if held is None else held.num_rows
            key_rows = list(zip(*(batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys)))
            rows = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in read)))
            for i, (k, row) in enumerate(zip(key_rows, rows)):
                if fold is None or k != at:
                    if fold is not None:
                        kept += fold(None, -1)
                    fold, at = make(), k
                kept += fold(row, base + start + i)
            # what is settled goes out; what a fold may still hold back (its last row) stays
            done = sorted(kept)
            if done:
                yield from table.take(pa.array([d - base for d in done])).combine_chunks().to_batches()
            kept = []
            held, base = table.slice(table.num_rows - 1), base + table.num_rows - 1
            pending = getattr(fold, "pending", lambda: None)()
            if pending is not None and pending < base:
                held, base = table.slice(pending - base + table.num_rows - 1), pending
        if fold is not None:
            done = fold(None, -1)
            if done:
                yield from held.take(pa.array([d - base for d in sorted(done)])).combine_chunks().to_batches()

    return dealt.select(names).mapInArrow(run, df.schema)


class _Greedy:
    def __init__(self):
        self.cursor = -1

    def __call__(self, row, number):
        if row is None or None in row or row[0] < self.cursor:
            return []
        self.cursor = row[1]
        return [number]


class _Longest:
    """At most one accepted span can overlap the next one in order, the last; it is held back until that is settled."""

    def __init__(self):
        self.last = None

    def pending(self):
        return self.last and self.last[2]

    def __call__(self, row, number):
        if row is None:
            return [self.last[2]] if self.last else []
        start, end = row
        if start is None or end is None:
            return []
        if self.last and start < self.last[1] and self.last[0] < end:
            if self.last[1] - self.last[0] < end - start:
                self.last = (start, end, number)
            return []
        out = [self.last[2]] if self.last else []
        self.last = (start, end, number)
        return out


def non_overlapping(spans: DataFrame, doc: str | list[str] = "doc_id", score: str = "score", seq: str = "seq") -> DataFrame:
    """Greedy from the left: by start, then longer, then higher score, then first seen; a span stays if it begins after the last kept one. Spans without a start or end go."""
    order = [F.col("start"), (F.col("end") - F.col("start")).desc(), F.coalesce(F.col(score), F.lit(0.0)).desc(), F.col(seq)]
    return streamed(spans, [doc] if isinstance(doc, str) else doc, order, _Greedy, ["start", "end"])


def longest_spans(spans: DataFrame, doc: str = "doc_id", seq: str = "seq") -> DataFrame:
    """Longest wins: by start, then longer; a span goes if one at least as long overlaps it, and ousts a shorter one. Spans without a start or end go."""
    return streamed(spans, [doc], [F.col("start"), (F.col("end") - F.col("start")).desc(), F.col(seq)], _Longest, ["start", "end"])


@F.arrow_udf(T.StringType())
def _spliced(text: pa.Array, edits: pa.Array) -> pa.Array:
    offsets, edit = edits.offsets.to_pylist(), edits.values
    starts, ends, puts = (edit.field(n).to_pylist() for n in ("start", "end", "put"))
    out: list[str | None] = []
    for i, whole in enumerate(text.to_pylist()):
        if whole is not None and edits[i].is_valid:
            parts, at = [], 0
            for k in range(offsets[i], offsets[i + 1]):
                parts += [whole[at : starts[k]], puts[k] or ""]
                at = ends[k]
            whole = "".join([*parts, whole[at:]])
        out.append(whole)
    return pa.array(out, pa.string())


def spliced(text: Column, edits: Column) -> Column:
    """The text with each of an array of (start, end, put) in place of what stands there; edits are disjoint and in order.

    A text is cut and joined once, so the work grows with the text and the edits: a substring for each edit, counted
    from the begin of the text, would grow with their product. A null array changes nothing; a null put is empty.
    """
    return _spliced(text, edits.cast("array<struct<start:int,end:int,put:string>>"))


def _edit(start: Column, end: Column, put: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), put.alias("put"))


def decorated(text: Column, spans: Column) -> Column:
    """Text with [surface](LABEL) for each of an array of disjoint (start, end, label), sorted by start."""
    closing = lambda m: F.concat(F.lit("]("), F.coalesce(tx.markup_label(m["label"]), F.lit("")), F.lit(")"))
    return spliced(text, F.flatten(F.transform(spans, lambda m: F.array(_edit(m["start"], m["start"], F.lit("[")), _edit(m["end"], m["end"], closing(m))))))


def decorate(docs: DataFrame, mentions: DataFrame, doc: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with column decorated: non-overlapping mentions marked inline. Mentions have start, end, label, score and seq."""
    kept = non_overlapping(mentions, doc).groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("start", "end", "label"))).alias("_spans"))
    joined = docs.join(kept, doc, "left").withColumn("_spans", F.coalesce("_spans", F.array().cast("array<struct<start:int,end:int,label:string>>")))
    return joined.withColumn("decorated", decorated(F.col(text_col), F.col("_spans"))).drop("_spans")


def clean_markup(c: Column) -> Column:
    """Text without inline markup."""
    return F.regexp_replace(c, ANNOTATION, "$1")


def parse_markup(docs: DataFrame, text_col: str = "markdown", context: int | None = None) -> DataFrame:
    """One row for each annotation: mention (0, 1, ..), entity, label (cleaned), start and end in the clean text, markdown_start, markdown_end, annotation_start and annotation_end.

    With `context`, a column context holds so many characters of the clean text to either side on one line, taken while the text is at hand.
    """
    keep = [c for c in docs.columns if c != text_col]
    add = ["mention", "start", "end", "markdown_start", "markdown_end", "annotation_start", "annotation_end"]
    texts = ["entity", "label"] + ["context"] * (context is not None)
    schema = ", ".join([f"`{n}` {t}" for n, t in docs.select(*keep).dtypes] + [f"{c} int" for c in add] + [f"{c} string" for c in texts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, rows = [], []
            for i, text in enumerate(batch.column(batch.schema.get_field_index(text_col)).to_pylist()):
                text, cut = text or "", 0
                clean = _annotation.sub(r"\1", text) if context is not None else ""
                for n, m in enumerate(_annotation.finditer(text)):
                    # each annotation before this one was longer than its surface by its marks and label
                    start = m.start() - cut
                    end = start + len(m[1])
                    source.append(i)
                    around = () if context is None else (clean[max(0, start - context) : end + context],)
                    rows.append((n, start, end, m.start(1), m.end(1), m.start(), m.end(), m[1], m[2], *around))
                    cut += len(m[0]) - len(m[1])
            if rows:
                base = batch.select(keep).take(pa.array(source))
                kinds = [pa.int32()] * 7 + [pa.string()] * len(texts)
                yield pa.RecordBatch.from_arrays([*base.columns, *(pa.array(x, t) for x, t in zip(zip(*rows), kinds))], names=[*keep, *add, *texts])

    out = docs.mapInArrow(run, schema).withColumn("label", tx.clean_label(F.col("label")))
    return out if context is None else out.withColumn("context", tx.one_line(F.col("context")))


class _Taken:
    """Disjoint ranges of a text that are in use."""

    def __init__(self):
        self.ranges: list[tuple[int, int]] = []

    def free(self, a: int, b: int) -> bool:
        i = bisect_left(self.ranges, (b,))
        return not i or self.ranges[i - 1][1] <= a

    def add(self, a: int, b: int) -> None:
        insort(self.ranges, (a, b))


#: Characters to either side in which an occurrence is first looked for; each time that there is none, four times as many.
REACH = 256


def best_occurrence(text: str, entity: str, near: int | None, taken: _Taken, begin: int = 0) -> tuple[int, int] | None:
    """The free exact occurrence nearest to `near`, the leftmost of two as near, or of all from `begin` on if `near` is None.

    The search widens around `near`, so it costs what lies between there and the occurrence, not the text.
    """
    size = len(entity)
    if not size:
        return None

    def right(at: int, end: int) -> int:
        while (at := text.find(entity, at, end)) >= 0 and not taken.free(at, at + size):
            at += 1
        return at

    def left(least: int, end: int) -> int:
        while (at := text.rfind(entity, least, max(end, 0))) >= 0 and not taken.free(at, at + size):
            end = at + size - 1
        return at

    if near is None:
        at = right(begin, len(text))
        return None if at < 0 else (at, at + size)
    reach = REACH
    while True:
        lo, hi = max(near - reach, 0), near + reach
        after = right(max(near, 0), max(hi + size, 0))
        before = left(lo if after < 0 else max(lo, 2 * near - after), near - 1 + size)
        if after >= 0 or before >= 0:
            at = after if before < 0 else before  # one to the left is only seen as near as that to the right
            return at, at + size
        if lo == 0 and hi >= len(text):
            return None
        reach *= 4


#: A mention as it is merged: see merge_master().
MASTER = "struct<entity:string,label:string,start:int,end:int,source_pass:string,context:string,masked:boolean>"


def places(text: str, wanted: list[tuple[str, int | None]]) -> list[tuple[int, int] | None]:
    """A free occurrence of each of the wanted surfaces, in their order; what one has taken is not free for the next."""
    taken, out = _Taken(), []
    begin: dict[str, int] = {}  # before it, a surface has no free occurrence: what is taken stays taken
    for surface, near in wanted:
        at = begin.get(surface, 0)
        out.append(best_occurrence(text, surface, near, taken, at) if at < len(text) else None)
        if out[-1]:
            taken.add(*out[-1])
        if out[-1] is None or near is None:
            begin[surface] = out[-1][1] if out[-1] else len(text)
    return out


def _with(df: DataFrame, add: str, work: Callable[[dict], dict], read: list[str]) -> DataFrame:
    """Each row with new columns that `work` makes of the columns `read`."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(add)
    arrow = to_arrow_schema(new)
    keep = [c for c in df.columns if c not in new.names]
    schema = StructType([*df.select(*keep).schema.fields, *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [work(r) for r in batch.select(read).to_pylist()]
            cols = [pa.array([r[f.name] for r in rows], f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, *cols], names=[*keep, *arrow.names])

    return df.mapInArrow(run, schema)


def _placed(df: DataFrame, text_col: str, wanted: Column, body_col: str) -> DataFrame:
    """`df` with column _placed: the elements of `wanted`, with surface and near, the span (a, b) that each has got, or null, and what is around it in the body."""
    width = tx.CONTEXT_CHARS

    def work(row: dict) -> dict:
        body, out = row["_body"] or "", []
        for span in places(row["_text"] or "", [(w["surface"], w["near"]) for w in row["_wanted"]]):
            out.append(span and {"a": span[0], "b": span[1], "around": body[max(0, span[0] - width) : span[1] + width]})
        return {"_spans": out}

    given = df.withColumns({"_wanted": F.coalesce(wanted, F.array()), "_text": F.col(text_col), "_body": F.col(body_col)})
    out = _with(given, "_spans array<struct<a:int,b:int,around:string>>", work, ["_wanted", "_text", "_body"])
    return out.withColumn("_placed", F.zip_with("_wanted", "_spans", lambda w, s: F.struct(w.alias("w"), s["a"].alias("a"), s["b"].alias("b"), s["around"].alias("around")))).drop("_wanted", "_spans", "_text", "_body")


def _merge_row(p: Column, source: str, masked: bool, context: Column) -> Column:
    """A placed mention as merge_master() takes it: with what is around it where it has a span (its surface stands there), else with `context`."""
    has = p["a"].isNotNull()
    fields = {
        "entity": p["w"]["surface"],
        "label": p["w"]["label"],
        "start": p["a"],
        "end": p["b"],
        "source_pass": F.when(has, source).otherwise(f"{source}_unmapped"),
        "context": F.when(has, tx.one_line(p["around"])).otherwise(context),
        "masked": F.when(has, masked).otherwise(False),
    }
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def _sorted_by(rows: Column, key: Callable[[Column], list[Column]]) -> Column:
    """An array in the order of the keys, equal ones as they stand."""
    keyed = F.transform(rows, lambda x, i: F.struct(*[k.alias(f"k{n}") for n, k in enumerate(key(x))], i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda y: y["x"])


def masked_text(text: Column, masks: Column) -> Column:
    """Text with asterisks for each of an array of disjoint masks, sorted by start."""
    return spliced(text, F.transform(masks, lambda m: _edit(m["start"], m["end"], F.repeat(F.lit("*"), m["end"] - m["start"]))))


def mask(chunks: DataFrame, text_col: str = "body", mentions_col: str = "mentions") -> DataFrame:
    """`chunks` with masked_text, masks, unmatched and master; mentions are an array of (entity, label, start, end, context).

    Longest surfaces are placed first, at the free occurrence nearest to where they were seen; what is masked, what has no
    place and what goes on to the merge all follow from those places. A null text is an empty one.
    """
    order = lambda m: [-F.length(F.coalesce(m["entity"], F.lit(""))), F.coalesce(m["start"], F.lit(0))]

    def want(m: Column) -> Column:
        surface, label = (tx.strip(F.coalesce(m[c], F.lit(""))) for c in ("entity", "label"))
        usable = (surface != "") & (label != "")
        fields = {"surface": F.when(usable, surface).otherwise(""), "entity": surface, "label": label, "near": m["start"], "end": m["end"], "context": F.when(m["context"] != "", m["context"])}
        return F.struct(*[c.alias(n) for n, c in fields.items()])

    keep = [c for c in chunks.columns if c not in ("masked_text", "masks", "unmatched", "master")]
    out = _placed(chunks.select(*keep), text_col, F.transform(_sorted_by(F.col(mentions_col), order), want), text_col)
    text, placed = F.coalesce(F.col(text_col), F.lit("")), F.col("_placed")
    old = lambda p: [p["w"]["near"].cast("int").alias("pass1_start"), p["w"]["end"].cast("int").alias("pass1_end")]
    names = lambda p: [p["w"]["entity"].alias("entity"), p["w"]["label"].alias("label")]
    reason = lambda p: F.when(p["w"]["surface"] == "", "empty entity or label").otherwise("no free exact occurrence").alias("reason")
    masks = F.transform(_sorted_by(F.filter(placed, lambda p: p["a"].isNotNull()), lambda p: [p["a"], p["b"]]), lambda p: F.struct(*names(p), p["a"].alias("start"), p["b"].alias("end"), *old(p)))
    unmatched = F.transform(F.filter(placed, lambda p: p["a"].isNull()), lambda p: F.struct(*names(p), *old(p), reason(p)))
    master = F.transform(F.filter(placed, lambda p: p["w"]["surface"] != ""), lambda p: _merge_row(p, "llm_pass1", True, p["w"]["context"]))
    late = lambda c: F.when(F.coalesce(c, F.lit(0)) == 0, LAST).otherwise(c)
    master = _sorted_by(master, lambda m: [m["start"].isNull(), late(m["start"]), late(m["end"]), m["entity"]])
    out = out.withColumns({"masks": masks, "unmatched": unmatched, "master": master.cast(f"array<{MASTER}>")})
    return out.withColumn("masked_text", masked_text(text, F.col("masks"))).select(*keep, "masked_text", "masks", "unmatched", "master")


def recall(masked: DataFrame, text_col: str = "body", found_col: str = "found") -> DataFrame:
    """`masked` with column recalled: what was found in the masked text (array of entity, label), each at its leftmost free occurrence, in the order found."""
    keep = [c for c in masked.columns if c != "recalled"]
    named = F.filter(F.col(found_col), lambda m: F.coalesce(m["entity"], F.lit("")) != "")
    wanted = F.transform(named, lambda m: F.struct(m["entity"].alias("surface"), m["label"].alias("label"), F.lit(None).cast("int").alias("near")))
    out = _placed(masked.select(*keep), "masked_text", wanted, text_col)
    rows = F.transform("_placed", lambda p: _merge_row(p, "llm_masked_pass", False, F.lit(None).cast("string")))
    return out.withColumn("recalled", rows.cast(f"array<{MASTER}>")).drop("_placed")


def _fold_text(value: str) -> str:
    return re.sub(r"\s+", " ", value.casefold()).strip()


class _Merge:
    """Which mentions repeat one kept before: see merge_master(). Ranges that are kept for one key are disjoint, so a search finds the only possible rival."""

    def __init__(self):
        self.spans: set = set()
        self.local: set = set()
        self.by_text: dict = {}
        self.by_chunk: dict = {}
        self.keys: dict = {}

    @staticmethod
    def _meets(ranges: list, a: int, b: int) -> bool:
        i = bisect_left(ranges, (b,))
        return any(x < b and y > a for x, y in ranges[max(0, i - 2) : i])

    def __call__(self, row, number):
        if row is None:
            return []
        entity, label, chunk, start, end, g_start, g_end, *settled = row
        key = (_fold_text(entity or ""), (label or "").casefold())
        whole, local = g_start is not None and g_end is not None, start is not None and end is not None
        if any(settled):  # kept before: it counts, and doesn't come again
            self._keep(key, chunk, (start, end) if local else None, (g_start, g_end) if whole else None)
            return []
        if whole and ((g_start, g_end) in self.spans or self._meets(self.by_text.get(key, []), g_start, g_end)):
            return []
        here = self.by_chunk.setdefault(chunk, [])
        if local and ((chunk, start, end) in self.local or self._meets(here, start, end)):
            return []
        seen = self.keys.get((chunk, *key))
        if seen is not None and (not local or seen == "unmapped"):
            return []
        self._keep(key, chunk, (start, end) if local else None, (g_start, g_end) if whole else None)
        return [number]

    def _keep(self, key, chunk, local, whole):
        if whole:
            self.spans.add(whole)
            insort(self.by_text.setdefault(key, []), whole)
        if local:
            self.local.add((chunk, *local))
            insort(self.by_chunk.setdefault(chunk, []), local)
        if not local or (chunk, *key) not in self.keys:
            self.keys[chunk, *key] = "mapped" if local else "unmapped"


#: What a merge reads of a mention, and the mentions of a document beyond which it is merged in parts.
_MERGED = ["entity", "label", "chunk", "start", "end", "global_start", "global_end"]
WHOLE_MENTIONS = 200_000


def _merge_order(seq: str) -> list[Column]:
    late = lambda c: [F.col(c).isNull(), F.when(F.col(c) == 0, LAST).otherwise(F.col(c))]
    return [*late("global_start"), F.col("chunk"), *late("start"), F.length("entity").desc(), F.col("label"), F.col("source_pass"), F.col(seq)]


def merge_master(mentions: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Mentions of all passes and chunks without repeats, within each of `keys` (a run and its document).

    Columns: entity, label, chunk, start, end, global_start, global_end, source_pass, seq. In order, a mention goes if a kept one has its global
    span, or overlaps it globally with the same folded text and label; or if one of its chunk has or overlaps its span;
    or, where either has no span, if one of its chunk has its folded text and label. Offsets of 0 come last in the order.
    A document is one stream of a task; see merge_parts() for documents without a bound.
    """
    return streamed(mentions, keys, _merge_order(seq), _Merge, _MERGED)


def _joined(df: DataFrame, side: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """A join on columns of which two nulls are equal."""
    renamed = side.withColumnsRenamed({c: f"_on_{c}" for c in on})
    return df.join(renamed, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on], how).drop(*(f"_on_{c}" for c in on))


def islands(spans: DataFrame, keys: list[str], start: str = "start", end: str = "end", target: str = "island") -> DataFrame:
    """`spans` with the begin of the island each lies in: spans that overlap or touch, one by way of the next, share one. Written once.

    Spans are dealt over ranges of place, so a document is no single task's. What reaches into a range from those before it
    is a row or two for each range: the furthest end so far, and the begin of the island that it belongs to.
    """
    dealt = spans.repartitionByRange(*keys, start).withColumn("_part", F.spark_partition_id())
    rows = stages.written(dealt, "ranges")  # ranges are sampled, and may come out otherwise when made again
    here = ["_part", *keys]
    ahead = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*here).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*here).orderBy(start).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def carried(per: DataFrame, value: Column, name: str) -> DataFrame:
        """What comes from earlier ranges into those that a document goes on in: two rows for each range at most."""
        return F.broadcast(per.withColumn(name, value).where(F.col(name).isNotNull()).select(*here, name))

    ends = carried(rows.groupBy(*here).agg(F.max(end).alias("_max")), F.max("_max").over(ahead), "_reach")
    found = _joined(rows, ends, here).withColumn("_seen", F.greatest("_reach", F.max(end).over(before)))
    found = found.withColumn("_begin", F.when(F.col("_seen").isNull() | (F.col(start) > F.col("_seen")), F.col(start))).drop("_reach", "_seen")
    found = found.withColumn("_own", F.last("_begin", ignorenulls=True).over(upto))
    last = carried(found.groupBy(*here).agg(F.max("_begin").alias("_max")), F.max("_max").over(ahead), "_from")
    return _joined(found, last, here).withColumn(target, F.coalesce("_own", "_from")).drop("_begin", "_own", "_from", "_part")


def merge_parts(mentions: DataFrame, keys: list[str], seq: str = "seq", most: int = WHOLE_MENTIONS) -> DataFrame:
    """merge_master() for documents of any size: those with more than `most` mentions are not one task's.

    Where offsets in chunks and documents go together, mentions repeat each other only within an island of overlapping spans, so
    islands are merged each for itself. Mentions without a place in the document come after all others and are held against
    their chunk alone, together with what is kept of it by then. Documents whose offsets don't go together stay whole.
    """
    rows = stages.written(mentions, "mentions")
    placed = F.col("global_start").isNotNull()
    shift = F.when(placed, F.col("global_start") - F.col("start"))
    whole = F.col("global_end").isNotNull() & F.col("start").isNotNull() & F.col("end").isNotNull()
    odd = placed & ~F.coalesce(whole & (F.col("global_end") - F.col("end") == F.col("global_start") - F.col("start")) & (F.col("end") >= F.col("start")), F.lit(False))
    per_chunk = rows.groupBy(*keys, "chunk").agg(F.count(F.lit(1)).alias("n"), F.max(odd).alias("odd"), (F.min(shift) != F.max(shift)).alias("torn"))
    per = per_chunk.groupBy(*keys).agg(F.sum("n").alias("n"), F.max(F.col("odd") | F.coalesce("torn", F.lit(False))).alias("odd"))
    large = stages.written(per.where((F.col("n") > most) & ~F.col("odd")).select(*keys), "large")
    some, small = _joined(rows, large, keys, "left_semi"), _joined(rows, large, keys, "left_anti")
    order, names = _merge_order(seq), rows.columns
    one = streamed(islands(some.where(placed), keys, "global_start", "global_end", "_island"), [*keys, "_island"], order, _Merge, _MERGED).select(*names)
    one = stages.written(one, "placed")  # part of the result, and of what is held against the rest
    rest = some.where(~placed).withColumn("_settled", F.lit(False))
    met = [*keys, "chunk"]
    beside = _joined(one, rest.select(*met).distinct(), met, "left_semi").withColumn("_settled", F.lit(True))
    two = streamed(beside.unionByName(rest), met, order, _Merge, [*_MERGED, "_settled"]).select(*names)
    return merge_master(small, keys, seq).unionByName(one).unionByName(two)
