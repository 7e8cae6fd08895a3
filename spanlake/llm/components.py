"""Connected components by alternating large-star and small-star steps, all in joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _sum(df: DataFrame) -> tuple:
    """Count and an order-free checksum of an edge table."""
    return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node that has a link to another one; root is the least node of its component.

    Links may repeat, run either way or join a node to itself; a link with a null end is none. A hub node is met by
    aggregates with map-side combine and by joins whose large partitions Spark can split, never by one collected group.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = materialize(pairs.distinct(), "edges", small=True)
    before = _sum(e)
    while True:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "large", small=True)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        e = materialize(small.distinct(), "small", small=True)
        now = _sum(e)
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
