"""The batch operators on streams: chunk files as they arrive, and running counts of mentions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import chunks


def chunk_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(path, value) of chunk files that appear under a folder, each once."""
    raw = spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "chunk_*.txt").schema(T.StructType([T.StructField("value", T.StringType())])).load(folder)
    return raw.select(F.col("_metadata.file_path").alias("path"), "value")


def bodies(stream: DataFrame) -> DataFrame:
    """Header columns and body of a stream of chunk files; lenient, so that one broken file doesn't end the stream."""
    return chunks.read_chunks(stream, strict=False)


def mention_counts(mentions: DataFrame, time_col: str, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Mentions by time window and label, with a watermark, so that state is bounded."""
    return mentions.withWatermark(time_col, late).groupBy(F.window(time_col, width), "label").agg(F.count(F.lit(1)).alias("n"))


def to_table(stream: DataFrame, folder: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], by: list[str]):
    """Run a batch transformation on each micro-batch and replace the partitions it touches; a repeated batch gives the same files."""

    def batch(df: DataFrame, number: int) -> None:
        transform(df).write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(folder)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
