"""Segmentation: paragraphs, sentences, token-budgeted chunks, word and sliding windows.

What splits by a pattern alone is a Column expression. What must carry on from row to row of a document (offsets,
packing, windows whose start depends on the one before) is one linear pass over each text in Arrow batches: nothing is
shuffled, and any token counter can be plugged in.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

#: Where a sentence ends, and where a paragraph does.
SENTENCE_END = r"""(?<=[.!?])(?:["')\]]+)?\s+(?=[A-Z0-9#*\-])|(?<=\n)\s*(?=\S)"""
PARAGRAPH = r"\S(?:.*?\S)?(?=\n\s*\n|\Z)"
#: Tokens of a chunk where a tokenizer's limit is unknown, the share of a known limit, and what is no limit at all.
UNKNOWN_LIMIT, LIMIT_SHARE, NO_LIMIT, LEAST_LIMIT = 4096, 0.85, 1_000_000, 32

Span = tuple[int, int]
_sentence, _paragraph, _word = re.compile(SENTENCE_END), re.compile(PARAGRAPH, re.DOTALL), re.compile(r"\S+")


def token_limit(requested: int | None, model_limit: int | None = None) -> int:
    """Tokens of a chunk: as requested (at least LEAST_LIMIT), else a share of the model's limit, else a cautious default."""
    if requested is not None:
        if requested < LEAST_LIMIT:
            raise ValueError(f"at least {LEAST_LIMIT} tokens")
        return requested
    if not model_limit or model_limit <= 0 or model_limit >= NO_LIMIT:
        return UNKNOWN_LIMIT
    return max(LEAST_LIMIT, int(model_limit * LIMIT_SHARE))


def whitespace_tokens(text: str) -> list[Span]:
    """The default token counter: spans of the white-space tokens."""
    return [m.span() for m in _word.finditer(text)]


#: Cuts at white space never part a token, so the tokens of a whole text tell those of any of its pieces.
whitespace_tokens.by_blanks = True


#: Characters on either side of a cut that are tokenised anew at first, and tokens that must then agree with the whole text's.
REPAIR, AGREEING = 96, 6


class _Patched:
    """Tokens of text[a:b] from the tokens of the whole text, which are found once: only what lies about the cuts is tokenised anew.

    A cut changes tokens near it. From the cut, a window is tokenised for itself; where its tokens have come to agree with
    those of the whole text, the whole text's go on. Windows that don't come to agree are made wider. What a cut needs is kept for
    other pieces with the same cut, so all pieces of a text together cost about one more pass over it. Tokenizers must be local: what
    is some words away must not matter. Those that cut at words, and byte-pair ones on top of them, are.
    """

    def __init__(self, text: str, tokens: Callable[[str], list[Span]]):
        self.text, self.tokens = text, tokens
        self._whole: tuple[list[Span], list[int]] | None = None
        self._heads: dict[int, tuple[int, int] | None] = {}
        self._tails: dict[int, tuple[int, int] | None] = {}

    @property
    def whole(self) -> tuple[list[Span], list[int]]:
        """Tokens of the text and their starts; found when they are first needed, as short pieces don't need them."""
        if self._whole is None:
            found = self.tokens(self.text)
            self._whole = found, [a for a, _ in found]
        return self._whole

    def _agreeing(self, part: list[Span]) -> tuple[int, int, int]:
        """The longest run of tokens of a window that are the text's, too: its length, its begin in the window and in the text."""
        every, starts = self.whole
        best, i = (0, 0, 0), 0
        while i < len(part):
            j, n = bisect_left(starts, part[i][0]), 0
            while i + n < len(part) and j + n < len(every) and every[j + n] == part[i + n]:
                n += 1
            best = max(best, (n, i, j), key=lambda x: x[0])
            i += max(n, 1)
        return best

    def _window(self, a: int, b: int) -> list[Span]:
        return [(a + x, a + y) for x, y in self.tokens(self.text[a:b])]

    def _head(self, a: int) -> tuple[int, int] | None:
        """(tokens of text[a:] before the text's own go on, number of the text's token that goes on); None if they never do."""
        if a not in self._heads:
            width, found = REPAIR, None
            while found is None:
                part = self._window(a, a + width)
                n, i, j = self._agreeing(part)
                # the window's end is a cut itself: the run must end before it, so that it isn't an accident of both
                if n >= AGREEING:
                    found = (i, j)
                elif a + width >= len(self.text):
                    break
                width *= 2
            self._heads[a] = found
        return self._heads[a]

    def _tail(self, b: int) -> tuple[int, int] | None:
        """(number of the text's token from which text[:b] has its own, how many these are)."""
        if b not in self._tails:
            width, found = REPAIR, None
            while found is None:
                part = self._window(max(0, b - width), b)
                n, i, j = self._agreeing(part)
                if n >= AGREEING:
                    found = (j + n, len(part) - i - n)
                elif width >= b:
                    break
                width *= 2
            self._tails[b] = found
        return self._tails[b]

    def __call__(self, a: int, b: int) -> int:
        if b - a > 2 * REPAIR and (head := self._head(a)) and (tail := self._tail(b)) and head[1] + AGREEING <= tail[0]:
            return head[0] + tail[0] - head[1] + tail[1]
        return len(self.tokens(self.text[a:b]))


def _own_counter(text: str, tokens: Callable[[str], list[Span]]) -> Callable[[int, int], int] | None:
    return tokens.counter(text) if hasattr(tokens, "counter") else None


def _counter(text: str, tokens: Callable[[str], list[Span]], anywhere: bool = False) -> Callable[[int, int], int]:
    """Tokens of text[a:b]: as the tokenizer's own counter tells, or looked up where cuts don't part tokens (unless pieces begin or end `anywhere`), else found about the cuts."""
    if own := _own_counter(text, tokens):
        return own
    if anywhere or not getattr(tokens, "by_blanks", False):
        return _Patched(text, tokens)
    starts = [a for a, _ in tokens(text)]
    return lambda a, b: bisect_left(starts, b) - bisect_left(starts, a)


def _trimmed(text: str, a: int, b: int) -> Span | None:
    """The span without white space at its ends; None if nothing is left."""
    part = text[a:b]
    left = len(part) - len(part.lstrip())
    size = len(part.strip())
    return (a + left, a + left + size) if size else None


def paragraphs(text: str) -> list[Span]:
    return [s for m in _paragraph.finditer(text) if (s := _trimmed(text, *m.span()))]


def sentences(text: str, a: int = 0, b: int | None = None) -> list[Span]:
    """Sentence spans of text[a:b], by its own boundaries."""
    part = text[a:b]
    cuts = [0, *(m.end() for m in _sentence.finditer(part)), len(part)]
    return [(a + s[0], a + s[1]) for x, y in zip(cuts, cuts[1:]) if (s := _trimmed(part, x, y))]


def _pieces(text: str, a: int, b: int) -> list[Span]:
    """A sentence cut after commas, semicolons and colons; into words if there are none."""
    part = text[a:b]
    cuts = [m.span() for m in re.finditer(r"(?<=[,;:])\s+", part)]
    if not cuts:
        return [(a + m.start(), a + m.end()) for m in _word.finditer(part)]
    starts, ends = [0, *(y for _, y in cuts)], [*(x for x, _ in cuts), len(part)]
    return [(a + x, a + y) for x, y in zip(starts, ends) if y > x]


def split_oversized(text: str, a: int, b: int, tokens: Callable[[str], list[Span]], most: int, count: Callable[[int, int], int] | None = None) -> list[Span]:
    """Spans of at most `most` tokens that cover a sentence of more: pieces joined as far as they fit, one too long by itself cut at tokens.

    Spans are those of the source, so offsets stay true where pieces are parted by more than one space. `count` may tell the tokens of a piece.
    """
    count = count or _counter(text, tokens)
    fits = lambda x, y: count(x, y) <= most
    out: list[Span] = []
    grows = False  # whether the last span may take in the next piece
    for x, y in _pieces(text, a, b):
        if grows and fits(out[-1][0], y):
            out[-1] = (out[-1][0], y)
        elif grows := fits(x, y):
            out.append((x, y))
        else:
            found = tokens(text[x:y])
            ends = zip(found[::most], found[most - 1 :: most] + found[-1:])
            out += [s for (first, _), (_, last) in ends if (s := _trimmed(text, x + first, x + last))]
    return out


def units(text: str, tokens: Callable[[str], list[Span]], most: int, whole: bool = False, count: Callable[[int, int], int] | None = None) -> list[Span]:
    """Sentences of all paragraphs, those over the budget split; with `whole`, they stay as they are. `count` may tell the tokens of a piece."""
    count, out = count or _counter(text, tokens), []
    for p in paragraphs(text):
        for s in sentences(text, *p):
            out += [s] if whole or count(*s) <= most else split_oversized(text, *s, tokens, most, count)
    return out


def chunks(text: str, tokens: Callable[[str], list[Span]], most: int, whole: bool = False) -> list[tuple[int, int, int, int]]:
    """(start, end, tokens, units) of chunks of whole units within the budget. With `whole`, a sentence over the budget is a chunk of its own.

    A chunk begins with the last unit of the one before where both fit, so mentions at a cut are seen whole once.
    """
    own = _own_counter(text, tokens)
    every, out = units(text, tokens, most, whole, own), []
    # units that a tokenizer had to cut may begin within a word
    count = own or _counter(text, tokens, anywhere=any(text[a - 1 : a].strip() for a, _ in every if a))
    first = 0
    for i, (_, end) in enumerate(every):
        if i > first and count(every[first][0], end) > most:
            a, b = every[first][0], every[i - 1][1]
            out.append((a, b, count(a, b), i - first))
            first = i - 1 if count(every[i - 1][0], end) <= most else i
    if every:
        a, b = every[first][0], every[-1][1]
        out.append((a, b, count(a, b), len(every) - first))
    return out


class _Stops:
    """Where windows may be cut: the ends of runs of white space that follow the end of a sentence or hold a line break."""

    def __init__(self, text: str):
        self.text = text
        self.runs = [m.span() for m in re.finditer(r"\s+", text)]

    def last(self, lo: int, cut: int) -> int | None:
        """The last one within text[lo:cut], of which nothing else is seen."""
        i = bisect_left(self.runs, (cut,))
        while i and (run := (max(self.runs[i - 1][0], lo), min(self.runs[i - 1][1], cut)))[0] < run[1]:
            i, (a, b) = i - 1, run
            if self.text[max(a - 1, lo) : a] in (".", "!", "?") or "\n" in self.text[a:b]:
                return b
        return None


def sliding(text: str, most: int, stride: int, snap: int | None = None) -> list[Span]:
    """Windows of at most `most` characters, `stride` apart, both ends drawn back to a sentence end within the snap width."""
    if stride >= most:
        raise ValueError("the stride must be less than the window")
    width, size, stops = most - stride if snap is None else snap, len(text), _Stops(text)

    def drawn(begin: int, far: int) -> int:
        cut = begin + far
        return size if cut >= size else (stops.last(max(begin, cut - width), cut) or cut)

    out: list[Span] = []
    begin = end = 0
    while begin < size and end < size:
        end = drawn(begin, most)
        out.append((begin, end))
        begin = max(begin + 1, drawn(begin, stride))
    return out


def packed_stream(paras: Iterable[str], most: int, sep: str = "\n\n", legacy: bool = False, stride: int | None = None) -> Iterator[tuple[int, str, str]]:
    """(offset, text, kind) of chunks of whole paragraphs of at most `most` characters, as the paragraphs come; longer ones go through sliding().

    Offsets are those of all paragraphs joined. With `legacy`, a chunk that follows a full one counts a separator too many, and too long
    paragraphs use the default stride of 35,000, which fails for smaller windows; else the stride is 7/8 of the window.
    """
    held: list[str] = []
    at = size = 0  # where the held paragraphs begin, and their characters with separators after them
    room = most
    for p in paras:
        if held and (len(p) > most or size + len(p) > room):
            yield at, sep.join(held), "structural"
            at, size, held = at + size, 0, []
            room = most - len(sep) if legacy else most
        if len(p) > most:
            step = stride if stride is not None else 35_000 if legacy else most * 7 // 8
            yield from ((at + a, p[a:b], "sliding_window") for a, b in sliding(p, most, step))
            at, room = at + len(p) + len(sep), most
            continue
        held.append(p)
        size += len(p) + len(sep)
    if held:
        yield at, sep.join(held), "structural"


def packed_paragraphs(paras: Iterable[str], most: int, sep: str = "\n\n", legacy: bool = False, stride: int | None = None) -> list[tuple[int, str, str]]:
    return list(packed_stream(paras, most, sep, legacy, stride))


#: Rows and characters of a batch that text_rows() gives at once.
BATCH_ROWS, BATCH_CHARS = 10_000, 4 << 20


def text_rows(df: DataFrame, text_col: str, add: str, work: Callable[[str], Iterable[tuple]]) -> DataFrame:
    """Each row once for each tuple that `work` makes of its text, with the tuple's fields as new columns `add` in the place of the text.

    The text isn't carried along, and rows go on as they are made: a text of many parts is held once.
    """
    fields = [x.split() for x in add.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    keep = [c for c in df.columns if c != text_col and c not in {n for n, _ in fields}]
    schema = ", ".join([f"`{n}` {t}" for n, t in df.select(*(f"`{c}`" for c in keep)).dtypes] + [f"`{n}` {t}" for n, t in fields])
    long = [k for k, (_, t) in enumerate(fields) if t == "string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, source, found, size = batch.select(keep), [], [], 0

            def rows() -> pa.RecordBatch:
                columns = kept.take(pa.array(source, pa.int32())).columns if keep else []
                new = [pa.array(x, kinds[t]) for x, (_, t) in zip(zip(*found), fields)]
                return pa.RecordBatch.from_arrays([*columns, *new], names=[*keep, *(n for n, _ in fields)])

            for i, text in enumerate(batch.column(batch.schema.get_field_index(text_col))):
                for row in work(text.as_py() or ""):
                    source.append(i), found.append(row)
                    size += sum(len(row[k] or "") for k in long)
                    if len(found) >= BATCH_ROWS or size >= BATCH_CHARS:
                        yield rows()
                        source, found, size = [], [], 0
            if found:
                yield rows()

    return df.mapInArrow(run, schema)


def sentence_table(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row for each sentence: `docs` with sentence (0, 1, ..), start, end and body instead of the text."""

    def work(text: str) -> Iterator[tuple]:
        body = text.strip()
        shift = len(text) - len(text.lstrip())
        for i, (a, b) in enumerate(s for p in paragraphs(body) for s in sentences(body, *p)):
            yield i, a + shift, b + shift, body[a:b]

    return text_rows(docs, text_col, "sentence int, start int, end int, body string", work)


def paragraph_table(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row for each paragraph: paragraph (0, 1, ..), start, end and body."""

    def work(text: str) -> Iterator[tuple]:
        body = text.strip()
        shift = len(text) - len(text.lstrip())
        for i, (a, b) in enumerate(paragraphs(body)):
            yield i, a + shift, b + shift, body[a:b]

    return text_rows(docs, text_col, "paragraph int, start int, end int, body string", work)


def chunk_table(docs: DataFrame, most: int, text_col: str = "text", tokens: Callable[[str], list[Span]] = whitespace_tokens, whole: bool = False) -> DataFrame:
    """One row for each chunk: chunk_index, char_start, char_end, token_count, n_units and body; offsets are those of the text. `whole`: see chunks()."""

    def work(text: str) -> Iterator[tuple]:
        shift = len(text) - len(text.lstrip())
        for i, (a, b, n, k) in enumerate(chunks(text.strip(), tokens, most, whole)):
            yield i, a + shift, b + shift, n, k, text[a + shift : b + shift]

    return text_rows(docs, text_col, "chunk_index int, char_start int, char_end int, token_count int, n_units int, body string", work)


def with_overlap(chunked: DataFrame, doc: str = "doc_id") -> DataFrame:
    """overlap_chars_with_previous and overlap_with_previous of each chunk."""
    before = F.lag("char_end").over(Window.partitionBy(doc).orderBy("chunk_index"))
    chars = F.greatest(F.coalesce(before - F.col("char_start"), F.lit(0)), F.lit(0))
    return chunked.withColumn("overlap_chars_with_previous", chars).withColumn("overlap_with_previous", chars > 0)


def window_table(docs: DataFrame, size: int, overlap: int, text_col: str = "text") -> DataFrame:
    """One row for each window of `size` words: window, start, end and body. The whole text if it has no more words, or size is 0."""
    step = max(1, size - max(0, min(overlap, size - 1)))

    def work(text: str) -> Iterator[tuple]:
        w = whitespace_tokens(text)
        if size <= 0 or len(w) <= size:
            yield 0, 0, len(text), text
            return
        for i, s in enumerate(range(0, len(w), step)):
            a, b = w[s][0], w[min(s + size, len(w)) - 1][1]
            yield i, a, b, text[a:b]
            if s + size >= len(w):
                return

    return text_rows(docs, text_col, "window int, start int, end int, body string", work)


def sliding_table(docs: DataFrame, most: int, stride: int, snap: int | None = None, text_col: str = "text") -> DataFrame:
    """One row for each sliding window: chunk_index, start, end and body."""

    def work(text: str) -> Iterator[tuple]:
        for i, (a, b) in enumerate(sliding(text, most, stride, snap)):
            yield i, a, b, text[a:b]

    return text_rows(docs, text_col, "chunk_index int, start int, end int, body string", work)


def packed_table(docs: DataFrame, most: int, text_col: str = "text", cut: str = "\n", sep: str = "\n\n", legacy: bool = False) -> DataFrame:
    """One row for each chunk of whole paragraphs (parts between `cut`, blanks collapsed): chunk_index, global_offset, kind and body."""

    def work(text: str) -> Iterator[tuple]:
        paras = [p for x in text.split(cut) if (p := re.sub(r"[ \t]+", " ", x).strip())]
        for i, (at, body, kind) in enumerate(packed_paragraphs(paras, most, sep, legacy)):
            yield i, at, kind, body

    return text_rows(docs, text_col, "chunk_index int, global_offset int, kind string, body string", work)


def sentence_array(c: Column) -> Column:
    """Sentences as an array of text, where offsets aren't needed: no Python, no row more. At most eight closers are seen at a boundary."""
    cut = r"""(?U)(?<=[.!?]["')\]]{0,8})\s+(?=[A-Z0-9#*\-])|(?<=\n)\s*(?=\S)"""
    return F.filter(F.transform(F.split(tx.strip(c), cut), tx.strip), lambda x: x != "")


def select_chunks(chunked: DataFrame, numbers: list[int] | None = None, column: str = "chunk_index") -> DataFrame:
    """The chosen chunks, or all."""
    return chunked if numbers is None else chunked.where(F.col(column).isin(numbers))
