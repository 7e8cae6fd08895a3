"""Shared pieces of the training-data operators: tables, materialisation, Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes that a Python worker handles at once; a longer single text is handled alone.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only where it is unset and all run on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spanlake-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def materialize(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """Write `df` as Parquet to a fresh place under the shared folder and read it back: the lineage ends there.

    A `small` table, of a few numbers to a row and far fewer rows than the input, is written by an eighth of the tasks.
    """
    if small:
        df = df.coalesce(max(8, partitions(df.sparkSession) // 8))
    path = f"{shared_dir(df.sparkSession)}/spanlake/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def on_disk(df: DataFrame) -> DataFrame:
    """`df`, whose rows stay on the executors' disks once computed.

    A task that writes files to a local folder starts a few processes to set permissions, each of which counts as a second
    executor until its own program runs; what a query reads again and nobody else does needs no files.
    """
    return df.persist(StorageLevel.DISK_ONLY)


def path_of(written: DataFrame) -> str:
    """Where materialize() has put this table."""
    return written._written_to


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table of materialize() that nothing will read again."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (n + 1) and the bytes of a string or binary array; a null is an empty value."""
    kind = array.type
    array = array.cast(pa.large_binary())
    if array.null_count:
        array = array.fill_null(b"")
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    del kind
    return off - off[0], raw[off[0] : off[-1]] if len(off) else raw


def text_bytes(array: pa.Array) -> list[bytes]:
    """UTF-8 values; a null is an empty value."""
    off, raw = text_buffers(array)
    data, ends = raw.tobytes(), off.tolist()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def by_bytes(batches: Iterator[pa.RecordBatch], name: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `most` bytes of column `name` each."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        off, _ = text_buffers(column(batch, name))
        start = 0
        while start < n:
            end = int(np.searchsorted(off, off[start] + most, side="right")) - 1
            end = min(n, max(start + 1, end))
            yield batch.slice(start, end - start)
            start = end


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of the batches that go to Python workers, unless the session has a bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("67108864b", "64MB", "256MB"):
        spark.conf.set(key, str(2 * CHUNK_BYTES))


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | T.StructType, text: str | None = None, most: int = CHUNK_BYTES) -> DataFrame:
    """mapInArrow of a function of one batch; with `text`, batches are sliced by the bytes of that column first."""

    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text, most) if text else batches:
            out = work(batch)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def crc_fold(id_col: str, folds: int):
    """crc32 of the id written as text, modulo `folds`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds
