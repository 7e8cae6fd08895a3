"""Taggers: the model behind mention extraction is pluggable; patterns and word lists are offline stand-ins."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .segment import whitespace_tokens

#: Words of a window, and words that two windows share.
WINDOW_WORDS, OVERLAP_WORDS = 220, 50


class Tagger(Protocol):
    """Anything that finds mentions in a text. One that has predict_many() is given the windows of many texts at once;
    one that has after_text() is told after each text. See models.ModelTagger for models that a worker loads once."""

    def predict(self, text: str, labels: list[str], threshold: float) -> Iterable[tuple[int, int, str, float]]:
        """(start, end, label, score) of mentions in the text."""


class PatternTagger:
    """A pattern and a score for each label."""

    def __init__(self, patterns: dict[str, tuple[str, float]]):
        self.patterns = {label: (re.compile(p), s) for label, (p, s) in patterns.items()}

    def predict(self, text, labels, threshold):
        for label in labels:
            p, s = self.patterns.get(label, (None, 0.0))
            if p is not None and s >= threshold:
                for m in p.finditer(text):
                    yield m.start(), m.end(), label, s


class GazetteerTagger:
    """Whole words of a list, by label."""

    def __init__(self, words: dict[str, list[str]], score: float = 1.0):
        self.label = {w: label for label, ws in words.items() for w in ws}
        self.score = score

    def predict(self, text, labels, threshold):
        for m in re.finditer(r"\w+", text):
            label = self.label.get(m[0])
            if label in labels and self.score >= threshold:
                yield m.start(), m.end(), label, self.score


#: Windows that a tagger with predict_many() is given at once.
WINDOWS_AT_ONCE = 256


def _windows(text: str, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    w = whitespace_tokens(text)
    if size <= 0 or len(w) <= size:
        yield 0, len(text)
        return
    step = max(1, size - max(0, min(overlap, size - 1)))
    for s in range(0, len(w), step):
        yield w[s][0], w[min(s + size, len(w)) - 1][1]
        if s + size >= len(w):
            return


def _predicted(tagger: Tagger, texts: Iterable[str], labels: list[str], threshold: float, size: int, overlap: int) -> Iterator[tuple[int, str, int, int, Iterable[tuple[int, int, str, float]]]]:
    """(number of the text, text, window, its begin, mentions) in order, windows gathered for a tagger that takes many."""
    many, after = getattr(tagger, "predict_many", None), getattr(tagger, "after_text", None)
    held: list[tuple[int, str, int, int, int]] = []

    def settle() -> Iterator[tuple]:
        found = many([text[a:b] for _, text, _, a, b in held], labels, threshold)
        yield from ((i, text, w, a, x) for (i, text, w, a, _), x in zip(held, found, strict=True))
        held.clear()

    for i, text in enumerate(texts):
        for w, (a, b) in enumerate(_windows(text, size, overlap)):
            if many is None:
                yield i, text, w, a, tagger.predict(text[a:b], labels, threshold)
                continue
            held.append((i, text, w, a, b))
            if len(held) == WINDOWS_AT_ONCE:
                yield from settle()
        if after is not None:
            after()
    if held:
        yield from settle()


def tag(docs: DataFrame, tagger: Tagger, labels: list[str], threshold: float = 0.5, size: int = WINDOW_WORDS, overlap: int = OVERLAP_WORDS, text_col: str = "text", context: int | None = None, profile: ResourceProfile | None = None) -> DataFrame:
    """One row for each mention found in each window: seq, window, start, end (of the whole text), label, score, entity.

    Windows overlap, so mentions repeat: see dedupe(). With `context`, a column context holds so many characters to
    either side on one line, taken while the text is at hand: no join back to the documents. `profile` holds the
    resources of the stage that tags, such as models.stage_profile().
    """
    keep = [c for c in docs.columns if c != text_col]
    kinds = [("seq", pa.int32(), "int"), ("window", pa.int32(), "int"), ("start", pa.int32(), "int"), ("end", pa.int32(), "int"), ("label", pa.string(), "string"), ("score", pa.float64(), "double"), ("entity", pa.string(), "string")]
    kinds += [("context", pa.string(), "string")] * (context is not None)
    schema = ", ".join([f"`{n}` {t}" for n, t in docs.select(*keep).dtypes] + [f"{n} {t}" for n, _, t in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, rows, at, n = [], [], -1, 0
            texts = (x or "" for x in batch.column(batch.schema.get_field_index(text_col)).to_pylist())
            for i, text, w, a, found in _predicted(tagger, texts, labels, threshold, size, overlap):
                at, n = i, n if i == at else 0
                for s, e, label, score in found:
                    source.append(i)
                    around = () if context is None else (" ".join(text[max(0, a + s - context) : a + e + context].split()),)
                    rows.append((n, w, a + s, a + e, label, score, text[a + s : a + e], *around))
                    n += 1
            if rows:
                base = batch.select(keep).take(pa.array(source))
                yield pa.RecordBatch.from_arrays([*base.columns, *(pa.array(x, t) for x, (_, t, _) in zip(zip(*rows), kinds))], names=[*keep, *(n for n, *_ in kinds)])

    return docs.mapInArrow(run, schema, profile=profile)


def dedupe(mentions: DataFrame, doc: str | list[str] = "doc_id", seq: str = "seq") -> DataFrame:
    """One of the mentions that share document (one key or several), start, end and label: the best scored, the first of equals."""
    w = Window.partitionBy(*([doc] if isinstance(doc, str) else doc), "start", "end", "label").orderBy(F.coalesce("score", F.lit(0.0)).desc(), seq)
    return mentions.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def normalize(raw: DataFrame, text_col: str = "text") -> DataFrame:
    """entity, label, score, start, end and context of raw tagger rows, whose offsets may be start_pos and end_pos, whose label entity_type, whose surface text."""
    have = set(raw.columns)
    pick = lambda *names: F.coalesce(*[F.col(n) for n in names if n in have])
    start, end = F.coalesce(pick("start", "start_pos"), F.lit(-1)), F.coalesce(pick("end", "end_pos"), F.lit(-1))
    inside = (start >= 0) & (start < end) & (end <= F.length(text_col))
    sliced = F.when(inside, F.substring(F.col(text_col), start + 1, end - start)).otherwise("")
    surface = F.coalesce(*[tx.blank_to_null(F.col(n)) for n in ("surface", "entity") if n in have], sliced)
    label = tx.first_filled(*[F.col(n) for n in ("label", "entity_type") if n in have])
    context = F.coalesce(tx.context(F.col(text_col), start, end), F.lit(""))
    rest = [c for c in raw.columns if c not in {"start", "end", "start_pos", "end_pos", "surface", "entity", "label", "entity_type", "score", text_col, "context"}]
    return raw.select(*rest, surface.alias("entity"), label.alias("label"), "score", start.alias("start"), end.alias("end"), context.alias("context"))
