"""Stage boundaries: a written table ends the lineage where a result is used more than once or an iteration goes on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spanlake-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to a fresh place under the shared folder and read back: a lost executor costs no recomputation of what came before."""
    path = f"{shared_dir(df.sparkSession)}/spanlake/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
