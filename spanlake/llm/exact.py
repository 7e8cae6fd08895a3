"""Exact dedup with a heavy-hitter split.

Texts are the same when they are identical once each run of white space is one space; their sha256 stands for them, so
what moves is a digest, an id and a row number. Misra-Gries summaries of the tasks, added up, name every digest that may
hold more than twice an average counter's share of the rows. Those candidates are counted exactly, and the verified
winners, whose number has a proven bound, are broadcast: rows of frequent digests are settled where they lie. What is
left is dealt by digest; none of its groups exceeds a fraction of one shuffle partition, by the same bound.

Defined results: a null text is an empty one; a null id is larger than any other; of repeated rows with one id one stays,
the first written; other columns are not read, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bloom
from .common import column, materialize, partitions

#: Counters of a summary for each shuffle partition: a digest that is not found to be frequent fills less than an eighth of an average one.
COUNTERS = 16

_WHITE = "[\\x20\\x09-\\x0D]+"


def digest(text):
    """32 bytes of the text with each run of white space made one space."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _WHITE, " "), 256))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, digest) of each row, written once; `row` numbers the rows as they were written."""
    return materialize(docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), digest(F.col(text_col)).alias("digest")), "digests")


def misra_gries(counters: dict, counts: dict, k: int) -> dict:
    """At most k counters after `counts` are added: each is below its true count by at most (rows so far) / (k + 1)."""
    for x, n in counts.items():
        counters[x] = counters.get(x, 0) + n
    if len(counters) <= k:
        return counters
    over = int(np.partition(np.fromiter(counters.values(), np.int64, len(counters)), len(counters) - k - 1)[len(counters) - k - 1])  # the largest that has no place
    return {x: n - over for x, n in counters.items() if n > over}


def frequent(found: DataFrame, k: int, col: str = "digest") -> DataFrame:
    """The values of a binary column that may be frequent: at most k + 1, and every one with at least 2 / (k + 1) of all rows.

    A task's counters fall short by its rows / (k + 1) at most, so their sums fall short by all rows / (k + 1): a value
    of twice that share keeps a sum of at least one share, and no more than k + 1 sums can be so large.
    """
    total = found.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[bytes, int] = {}
        for batch in batches:
            seen = pc.value_counts(column(batch, col))
            counters = misra_gries(counters, dict(zip(seen.field(0).to_pylist(), seen.field(1).to_pylist())), k)
        yield pa.RecordBatch.from_arrays([pa.array(list(counters), pa.binary()), pa.array(list(counters.values()), pa.int64())], names=[col, "n"])

    sums = found.select(col).where(F.col(col).isNotNull()).mapInArrow(run, f"{col} binary, n long").groupBy(col).agg(F.sum("n").alias("n"))
    return sums.where(F.expr(f"n >= greatest(2, {total} / {k + 1})")).select(col)


def _least():
    """The first row by id, null ids last, then as written."""
    return F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row")))


def winners(found: DataFrame, k: int) -> DataFrame:
    """(digest, n, keep) of the frequent digests, counted exactly: at most k + 1 rows."""
    some = materialize(frequent(found, k), "frequent", small=True)
    return materialize(found.join(F.broadcast(some), "digest").groupBy("digest").agg(F.count(F.lit(1)).alias("n"), _least().alias("keep")), "winners", small=True)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of each row: of equal texts the one with the least id is kept.

    `counters` of a Misra-Gries summary, else COUNTERS for each shuffle partition.
    """
    found = digests(docs, id_col, text_col)
    top = F.broadcast(winners(found, counters or COUNTERS * partitions(docs.sparkSession)))
    at_home = found.join(top, "digest")
    same = Window.partitionBy("digest")
    dealt = found.join(top, "digest", "left_anti").select("*", F.count(F.lit(1)).over(same).alias("n"), _least().over(same).alias("keep"))
    rows = at_home.select("doc_id", "row", "digest", "n", "keep").unionByName(dealt)
    return rows.select("doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("keep.row")).alias("kept"), "digest")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of each row."""
    return groups(docs, id_col, text_col).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def _key(digest_col: str):
    return F.conv(F.substring(F.hex(digest_col), 2, 15), 16, 10).cast("long")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int | None = None) -> DataFrame:
    """The rows of `docs`, all columns, without those whose text a kept row has.

    Rows of frequent digests go or stay where they lie. A text moves only if its digest is not alone (or passes a
    filter of fixed size by mistake).
    """
    spark, names = docs.sparkSession, docs.columns
    found = digests(docs, id_col, text_col)
    top = winners(found, counters or COUNTERS * partitions(spark))
    rest = found.join(F.broadcast(top), "digest", "left_anti").groupBy("digest").agg(F.count(F.lit(1)).alias("n"), _least().alias("keep")).where("n > 1")
    rest = materialize(rest, "repeated")
    words = bloom.build(rest.select(_key("digest").alias("key")), "key")

    @F.pandas_udf("boolean")
    def may_repeat(keys: pd.Series) -> pd.Series:
        return pd.Series(bloom.contains(words, keys.to_numpy(np.int64)))

    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_doc"), F.col(id_col).alias("_id"), digest(F.col(text_col)).alias("digest"))
    keeps = lambda x: x.select("digest", F.col("keep.doc_id").alias("_keep"), F.lit(True).alias("_many"))
    packed = packed.join(F.broadcast(keeps(top)), "digest", "left")
    others = packed.where("_many IS NULL").drop("_keep", "_many").withColumn("_may", may_repeat(_key("digest")))
    met = others.where("_may").join(keeps(rest), "digest", "left")
    alone = others.where("NOT _may").select("_doc").unionByName(met.where("_many IS NULL").select("_doc"))
    chosen = packed.where("_many AND _id <=> _keep").select("digest", "_doc").unionByName(met.where("_many AND _id <=> _keep").select("digest", "_doc"))
    return alone.unionByName(chosen.groupBy("digest").agg(F.first("_doc").alias("_doc")).select("_doc")).select("_doc.*")  # repeated rows of one id: one
