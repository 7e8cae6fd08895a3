"""Vector code compression: product codebooks by exact integer Lloyd rounds, with norm-of-sum bounds.

Vectors become integers and are cut into equal parts; each part position has a codebook of a few entries. All codebooks
of all rounds are kept (they are small). For each part a row keeps its entry, a lower bound on its distance to every other
entry, and the round in which that bound was taken. The bound still holds less the true net displacement of the entries
since then: the norm of the sum of their moves, which is never more than the sum of the norms. While the exact distance to
the own entry is below it, the part stays; else all entries are measured again and the bound gets the stamp of the round.

A round is one pass: rows and bounds are written to the shared folder with one row of integer sums for each task; the sums
are added by Spark, and the driver sees one number for each component of a codebook. The table of the round before is then
removed, so at most two are there. Distances are integers, so no rounding decides; bounds are rounded to the safe side.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped; vectors shorter than the
longest, or than a multiple of the parts, end in zeros; components saturate at the largest size whose squares still fit
(2^27 at 64 components); a null id comes last among seeds; of one id, seeds go by vector; fewer rows than entries make
smaller codebooks; repeated rows each get a row; other columns are not read, whatever their names; an empty table gives an
empty one and empty codebooks; a label's error beyond a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, materialize, path_of, removed, text_buffers

#: A component x is the integer floor(SCALE * x).
SCALE = 4096
#: Rows that are compared at once.
ROWS = 1 << 13
#: Labels that are sent to every executor; beyond, they are dealt by label.
SENT_LABELS = 1 << 16


@dataclass(frozen=True)
class Shape:
    """How vectors are held: `parts` of `width` integers, within +-`limit`, `kind` a numpy type that holds them."""

    parts: int
    width: int
    limit: int
    kind: str


def as_integers(values: np.ndarray, limit: int) -> np.ndarray:
    return np.clip(np.floor(np.asarray(values, np.float64) * SCALE), -limit, limit).astype(np.int64)


def _saturation(dims: int) -> int:
    """The largest power of two whose squared differences, added over the components, fit a long."""
    return 1 << ((62 - max(dims - 1, 0).bit_length()) // 2 - 1)


def padded(array: pa.Array, shape: Shape) -> np.ndarray:
    """(rows, parts, width) integers of a list array without nulls."""
    sizes = np.diff(array.offsets.to_numpy()).astype(np.int64)
    out = np.zeros((len(sizes), shape.parts * shape.width), np.int64)
    flat = as_integers(array.flatten().to_numpy(zero_copy_only=False), shape.limit)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out.reshape(-1, shape.parts, shape.width)


def squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """(rows, entries) exact squared distances of integer rows to integer entries."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * most * most * max(1, x.shape[1]) < 1 << 53:  # every product and sum is a whole number that a float64 holds
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return ((x[:, None, :] - book[None]) ** 2).sum(2)


def net_moves(history: list[np.ndarray]) -> np.ndarray:
    """[round, part, entry]: how far any other entry than this one has got since that round, at most; rounded up."""
    now, out = history[-1], np.zeros((len(history), *history[-1].shape[:2]))
    for t, then in enumerate(history):
        moved = np.sqrt(((now - then).astype(np.float64) ** 2).sum(2)) * (1 + 1e-9)
        for k in range(moved.shape[1]):
            out[t, :, k] = np.delete(moved, k, axis=1).max(axis=1, initial=0)
    return out


@dataclass
class Bounds:
    """Of each row and part: the entry, a lower bound on the distance to the others, and the round it was taken in."""

    code: np.ndarray
    low: np.ndarray
    stamp: np.ndarray


def assign(x: np.ndarray, history: list[np.ndarray], old: Bounds | None, moves: np.ndarray) -> tuple[Bounds, np.ndarray, int]:
    """The nearest entries in the last codebooks (ties to the lower index), their squared distances, and how many parts were measured anew."""
    n, parts, _ = x.shape
    books, now = history[-1], len(history) - 1
    new = Bounds(np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.float32), np.full((n, parts), now, np.uint8))
    error, rescans = np.zeros((n, parts), np.int64), 0
    for p in range(parts):
        todo = np.arange(n)
        if old is not None:
            code, stamp = old.code[:, p], old.stamp[:, p]
            own = ((x[:, p] - books[p][code]) ** 2).sum(1)
            bound = old.low[:, p].astype(np.float64) - moves[stamp, p, code]
            kept = np.sqrt(own.astype(np.float64)) * (1 + 1e-9) < bound * (1 - 1e-9)
            new.code[:, p], new.low[:, p], new.stamp[:, p], error[:, p] = code, old.low[:, p], stamp, own
            todo = np.flatnonzero(~kept)
        rescans += len(todo)
        for at in range(0, len(todo), ROWS):
            rows = todo[at : at + ROWS]
            d = squared(x[rows, p], books[p])
            best, line = d.argmin(1), np.arange(len(rows))
            error[rows, p], new.code[rows, p], new.stamp[rows, p] = d[line, best], best, now
            rest = d.astype(np.float64)
            rest[line, best] = np.inf
            new.low[rows, p] = np.nextafter((np.sqrt(rest.min(1)) * (1 - 1e-9)).astype(np.float32), np.float32(0))
    return new, error, rescans


def added(x: np.ndarray, code: np.ndarray, entries: int) -> np.ndarray:
    """(parts, entries, width + 1) sums of the parts of each entry, and their number last."""
    n, parts, width = x.shape
    out = np.zeros((parts, entries, width + 1), np.int64)
    for p in range(parts):
        for c in range(width):
            out[p, :, c] = np.bincount(code[:, p], x[:, p, c], entries).astype(np.int64)  # below 2^53: a batch has few rows
        out[p, :, width] = np.bincount(code[:, p], minlength=entries)
    return out


def updated(books: np.ndarray, sums: dict[int, int]) -> np.ndarray:
    """The codebooks with each used entry at the floor of its mean."""
    parts, entries, width = books.shape
    out = books.copy()
    for k in range(parts * entries):
        base = k * (width + 1)
        if n := sums.get(base + width, 0):
            out[k // entries, k % entries] = [sums[base + c] // n for c in range(width)]
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary array with one value for each row of a contiguous matrix."""
    flat = np.ascontiguousarray(rows)
    wide = flat.itemsize * int(np.prod(flat.shape[1:]))
    return pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(np.arange(len(flat) + 1, dtype=np.int32) * wide), pa.py_buffer(flat)])


def _matrix(array: pa.Array, kind: str, *shape: int) -> np.ndarray:
    _, raw = text_buffers(array)
    return np.frombuffer(raw.tobytes(), kind).reshape(len(array), *shape)


def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    """The rows whose vector is not null and has finite components only."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vectors.where(F.col(vector_col).isNotNull() & ~F.exists(F.col(vector_col).cast("array<double>"), bad))


class _Run:
    """The rounds of one compression; each makes a table of rows with their bounds from the one before."""

    def __init__(self, rows: DataFrame, shape: Shape, books: np.ndarray):
        self.rows, self.shape, self.history, self.path, self.label = rows, shape, [books], None, rows.schema["label"].dataType
        self.rescans: list[int] = []

    def step(self, last: bool) -> DataFrame:
        """One assignment; unless it is the `last`, the codebooks are updated after it."""
        shape, history, first = self.shape, self.history, self.path is None
        moves, (parts, entries, width) = net_moves(history), history[-1].shape
        names = ["vec_id", "label"] + (["code", "error"] if last else ["v", "code", "low", "stamp", "sums"])

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, rescans, kinds = np.zeros((parts, entries, width + 1), np.int64), 0, None
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    some = batch.slice(at, ROWS)
                    kinds = [column(some, "vec_id").type, column(some, "label").type]
                    if first:
                        x, old = padded(column(some, "v"), shape), None
                    else:
                        x = _matrix(column(some, "v"), shape.kind, parts, width).astype(np.int64)
                        old = Bounds(_matrix(column(some, "code"), "u1", parts), _matrix(column(some, "low"), "<f4", parts), _matrix(column(some, "stamp"), "u1", parts))
                    new, error, n = assign(x, history, old, moves)
                    ids = [column(some, "vec_id"), column(some, "label")]
                    if last:
                        yield pa.RecordBatch.from_arrays([*ids, _binary(new.code), pa.array(error.sum(1))], names=names)
                        continue
                    total, rescans = total + added(x, new.code, entries), rescans + n
                    made = [_binary(x.astype(shape.kind)), _binary(new.code), _binary(new.low), _binary(new.stamp)]
                    yield pa.RecordBatch.from_arrays([*ids, *made, pa.nulls(len(x), pa.binary())], names=names)
            if kinds and not last:
                sums = np.append(total.ravel(), rescans).astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays([*(pa.nulls(1, k) for k in kinds), *(pa.nulls(1, pa.binary()) for _ in range(4)), pa.array([sums], pa.binary())], names=names)

        binary = [T.StructField(c, T.BinaryType()) for c in names[2:]]
        fields = [T.StructField("vec_id", T.LongType()), T.StructField("label", self.label), *binary]
        if last:
            fields[-1] = T.StructField("error", T.LongType())
        made = materialize(self.rows.mapInArrow(work, T.StructType(fields)), "codes" if last else "bounds")
        if self.path:
            removed(made.sparkSession, self.path)
        self.path = path_of(made)
        if last:
            return made
        self.rows = made.where("v IS NOT NULL").drop("sums")
        sums = self._sums(made)
        self.rescans.append(sums.pop(parts * entries * (width + 1)))
        self.history = [*history, updated(history[-1], sums)]
        return made

    @staticmethod
    def _sums(made: DataFrame) -> dict[int, int]:
        """The sums of all tasks; as many numbers as the codebooks have components, and the rescans."""

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for x in batch.column(0).to_pylist():
                    values = np.frombuffer(x, "<i8")
                    total = values.copy() if total is None else total + values
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "n"])

        one = made.select("sums").where("sums IS NOT NULL").mapInArrow(add, "i long, n long")
        return {r.i: int(r.n) for r in one.groupBy("i").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()}


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = None) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code binary, error) of each usable row, written, and the codebooks as (parts, entries, width) integers.

    The codebooks start as the parts of the first rows by id; `entries` and `rounds` are 255 at most.
    """
    if not (0 < entries < 256 and 0 <= rounds < 255 and parts > 0):
        raise ValueError("parts must be positive, entries 1 to 255, rounds 0 to 254")
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    rows = usable(vectors, vector_col).select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    size, top = rows.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
    width = -(-(size or 0) // parts)
    limit = _saturation(parts * width)
    small = (top or 0) * SCALE + 1 < 1 << 15
    shape = Shape(parts, width, limit, "<i2" if small else "<i4")
    first = [r.v for r in rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()]
    if not first:
        return rows.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")).limit(0), np.zeros((parts, 0, width), np.int64)
    seeds = padded(pa.array(first, pa.list_(pa.float64())), shape).transpose(1, 0, 2)
    run = _Run(rows, shape, np.ascontiguousarray(seeds))
    for _ in range(rounds):
        run.step(last=False)
    return run.step(last=True), run.history[-1]


def decompress(codes: DataFrame, books: np.ndarray, code_col: str = "code", vector_col: str = "embedding") -> DataFrame:
    """`codes` with the vector that each code stands for."""
    values = F.array(*(F.array(*(F.array(*(F.lit(float(x) / SCALE) for x in entry)) for entry in book)) for book in books))
    index = F.transform(F.sequence(F.lit(0), F.lit(len(books) - 1)), lambda p: F.element_at(F.element_at(values, p + 1), F.conv(F.hex(F.substring(F.col(code_col), p + 1, F.lit(1))), 16, 10).cast("int") + 1))
    return codes.withColumn(vector_col, F.flatten(index))


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()


def report(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, code as hex, error, label_error, codebooks_sha256) of each usable row."""
    made, books = compress(vectors, parts, entries, rounds, id_col, vector_col, label_col)
    by_label = made.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    if by_label.limit(SENT_LABELS + 1).count() <= SENT_LABELS:
        by_label = F.broadcast(by_label)
    rows = made.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))
