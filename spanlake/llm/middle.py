"""Fill-in-middle transformation on piece tables.

A document is a list of descriptors (buffer, start, stop) over two immutable buffers: its UTF-8 text and the sentinels.
Cutting splits a descriptor, an arrangement permutes descriptors, the inverse permutation puts them back, and a hash is
fed descriptor by descriptor, so no arrangement copies a text. A flat output is restored the same way: it becomes the
text buffer of a new table, which is cut at its sentinels and permuted back.

Defined results: a null text is an empty one (plain, no tokens); a null id counts as the empty text in the draw; repeated
rows and ids give a row each; other columns are not read, whatever their names; an empty table gives an empty one. Texts
are scanned in blocks, so a very long one takes its own size in memory and little more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, map_batches, text_bytes

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
TEXT, MARKS = 0, 1
MARK_PIECES = [(MARKS, 0, 3), (MARKS, 3, 6), (MARKS, 6, 9)]
#: Pieces in the order of each form; 0 to 2 are prefix, middle, suffix, 3 to 5 the sentinels <P>, <S>, <M>.
ORDERS = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}
#: The sentinels in the order in which a form's output shows them.
SHOWN = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: Bytes of a text that are looked at together.
BLOCK = 1 << 22

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


class PieceTable:
    """Descriptors over immutable buffers; they may be empty, so that every piece of an arrangement has a place."""

    __slots__ = ("buffers", "pieces")

    def __init__(self, buffers: tuple[bytes, ...], pieces: list[tuple[int, int, int]]):
        self.buffers, self.pieces = buffers, pieces

    @classmethod
    def of(cls, text: bytes) -> PieceTable:
        return cls((text, SENTINELS), [(TEXT, 0, len(text))])

    def cut(self, *places: int) -> PieceTable:
        """The table with a boundary at each of the ascending places of its content; equal places part empty pieces."""
        out, at, todo = [], 0, list(places)
        for n, (buffer, start, stop) in enumerate(self.pieces):
            last = n == len(self.pieces) - 1
            while todo and (todo[0] < at + stop - start or last and todo[0] <= at + stop - start):
                mid = start + todo.pop(0) - at
                out.append((buffer, start, mid))
                at, start = at + mid - start, mid
            out.append((buffer, start, stop))
            at += stop - start
        return PieceTable(self.buffers, out)

    def with_marks(self) -> PieceTable:
        return PieceTable(self.buffers, self.pieces + MARK_PIECES)

    def permuted(self, order: tuple[int, ...]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[k] for k in order])

    def inverted(self, order: tuple[int, ...]) -> PieceTable:
        """What permuted(order) was made of."""
        back = [(0, 0, 0)] * len(order)
        for piece, k in zip(self.pieces, order):
            back[k] = piece
        return PieceTable(self.buffers, back)

    def first(self, n: int) -> PieceTable:
        return PieceTable(self.buffers, self.pieces[:n])

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, stop in self.pieces:
            if start < stop:
                yield memoryview(self.buffers[buffer])[start:stop]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for x in self.stream():
            digest.update(x)
        return digest.hexdigest()

    def content(self) -> bytes:
        return b"".join(self.stream())


def _run_ends(text: bytes) -> Iterator[np.ndarray]:
    """By blocks, the places behind the runs of bytes that aren't white space: there a token ends."""
    raw = np.frombuffer(text, np.uint8)
    for a in range(0, len(raw), BLOCK):
        white = _WHITE[raw[a : a + BLOCK + 1]]
        if a + BLOCK >= len(raw):
            white = np.append(white, True)
        yield np.flatnonzero(white[1:] & ~white[:-1]) + (a + 1)


def n_tokens(text: bytes) -> int:
    """White space and what follows up to the next is a token; white space at the end is one, too."""
    return sum(len(x) for x in _run_ends(text)) + bool(text and _WHITE[text[-1]])


def token_ends(text: bytes, counts: tuple[int, ...]) -> list[int]:
    """Byte places behind so many tokens, for each of `counts`."""
    out, seen = [0 if k == 0 else len(text) for k in counts], 0
    for ends in _run_ends(text):
        for i, k in enumerate(counts):
            if seen < k <= seen + len(ends):
                out[i] = int(ends[k - seen - 1])
        seen += len(ends)
    return out


def n_chars(text: bytes, start: int, stop: int) -> int:
    """Code points between two byte places."""
    raw = np.frombuffer(text, np.uint8)
    return sum(int(np.count_nonzero((raw[a : min(a + BLOCK, stop)] & 0xC0) != 0x80)) for a in range(start, stop, BLOCK))


def draw(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers of 32 bits from the seed and the id."""
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(hexed[8 * k : 8 * k + 8], 16) for k in range(4)]


def arrange(doc_id: int | None, text: bytes, seed: int = 42, rate: int = 50, spm: int = 80) -> tuple[int, str, PieceTable]:
    """Number of tokens, form, and the output's piece table. A text that shows a sentinel stays plain."""
    n, table = n_tokens(text), PieceTable.of(text)
    h1, h2, h3, h4 = draw(doc_id, seed)
    if not text or h3 % 100 >= rate or any(x in text for x in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", table
    form = "spm" if h4 % 100 < spm else "psm"
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, form, table.cut(*token_ends(text, (low, high))).with_marks().permuted(ORDERS[form])


def restore(output: bytes, form: str) -> PieceTable:
    """The piece table of the text that `output` was made of, from the output and its form alone."""
    table = PieceTable.of(output)
    if form == "plain":
        return table
    places, at = [], 0
    for mark in SHOWN[form]:
        at = output.index(mark, at)
        places += [at, at + len(mark)]
        at += len(mark)
    return table.cut(*places[1:]).inverted(ORDERS[form]).first(3)  # the first sentinel starts the output


def _docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


_SHAPE = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def _shape(d: int | None, text: bytes, n: int, form: str, table: PieceTable) -> tuple:
    """The columns of _SHAPE."""
    if form == "plain":
        return d, n, form, None, None
    prefix, middle, _ = table.inverted(ORDERS[form]).pieces[:3]
    return d, n, form, n_chars(text, *prefix[1:]), n_chars(text, *middle[1:])


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)


_KINDS, _NAMES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()], ["doc_id", "n", "form", "prefix_chars", "middle_chars"]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, pieces, output): `rate` of 100 documents arranged, `spm` of 100 of those suffix first.

    `pieces` are the output's descriptors: buffer 0 is the text, buffer 1 the sentinels; start and stop are bytes.
    """
    piece = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for d, text in zip(column(batch, "doc_id").to_pylist(), text_bytes(column(batch, "text"))):
            n, form, table = arrange(d, text, seed, rate, spm)
            rows.append((*_shape(d, text, n, form, table), [dict(zip(("buffer", "start", "stop"), p)) for p in table.pieces], table.content().decode()))
        return _batch(rows, [*_KINDS, piece, pa.string()], [*_NAMES, "pieces", "output"])

    return map_batches(_docs(docs, id_col, text_col), work, f"{_SHAPE}, pieces array<struct<buffer:int,start:long,stop:long>>, output string", "text")


def restored(outputs: DataFrame, id_col: str = "doc_id", output_col: str = "output", form_col: str = "form") -> DataFrame:
    """(doc_id, text) of outputs and their forms; a null output is an empty text, a null form is plain."""
    rows = outputs.select(F.col(id_col).alias("doc_id"), F.col(output_col).cast("string").alias("text"), F.coalesce(form_col, F.lit("plain")).alias("form"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [restore(x, form).content().decode() for x, form in zip(text_bytes(column(batch, "text")), column(batch, "form").to_pylist())]
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_batches(rows, work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string", "text")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of each row; no text leaves a task.

    The output's digest comes from its descriptors; the restored one from the flat output and its form.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for d, text in zip(column(batch, "doc_id").to_pylist(), text_bytes(column(batch, "text"))):
            n, form, table = arrange(d, text, seed, rate, spm)
            rows.append((*_shape(d, text, n, form, table), table.sha256(), restore(table.content(), form).sha256()))
        return _batch(rows, [*_KINDS, pa.string(), pa.string()], [*_NAMES, "output_sha256", "restored_sha256"])

    return map_batches(_docs(docs, id_col, text_col), work, f"{_SHAPE}, output_sha256 string, restored_sha256 string", "text")
