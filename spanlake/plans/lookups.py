"""Lookups that last: a cache of service answers as versioned snapshots, and a table of failed terms that the next run takes up.

A store is a folder with the tables `answers` and `failures`. A version of a table is a folder of its own that is written
once and counts only when Spark's commit has marked it complete, so readers see whole versions and a run that dies
leaves the last one as it was. Terms to ask for are those that the answers don't have: new ones and failed ones alike.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, mapping, services
from . import stages

#: Terms that a cache holds at most, and versions that stay readable while newer ones are written.
MOST_TERMS, KEPT_VERSIONS = 1_000_000_000, 2


class Snapshots:
    """Numbered versions of a table under a folder."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def place(self, version: int) -> str:
        return f"{self.folder}/v={version:08d}"

    def _listed(self) -> list[int]:
        """Versions that were begun."""
        root = self._path(self.folder)
        names = [s.getPath().getName() for s in self._files.listStatus(root)] if self._files.exists(root) else []
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"v=(\d{8})", n)))

    def versions(self) -> list[int]:
        """Complete versions, the oldest first."""
        return [v for v in self._listed() if self._files.exists(self._path(f"{self.place(v)}/_SUCCESS"))]

    def read(self, version: int | None = None) -> DataFrame:
        """A version, or the last one; an empty table before the first."""
        if version is None:
            found = self.versions()
            if not found:
                return self.spark.createDataFrame([], self.schema)
            version = found[-1]
        return self.spark.read.schema(self.schema).parquet(self.place(version))

    def write(self, df: DataFrame, keep: int = KEPT_VERSIONS) -> int:
        """`df` as the next version; of the older ones, the last `keep` - 1 stay. Two writers at once: the later one fails and changes nothing."""
        version = (self._listed() or [0])[-1] + 1
        df.write.mode("errorifexists").parquet(self.place(version))
        for old in self.versions()[:-keep]:
            self._files.delete(self._path(self.place(old)), True)
        return version


class TermCache:
    """Answers of a service by term, first in, first out beyond `most` terms. Terms of one run are in the order of their text."""

    SCHEMA = f"term string, items array<{services.ITEM}>, added int"

    def __init__(self, spark: SparkSession, folder: str, most: int = MOST_TERMS):
        if most < 1:
            raise ValueError("a cache holds one term at least")
        self.table, self.most = Snapshots(spark, folder, self.SCHEMA), most

    def read(self) -> DataFrame:
        """(term, items, added): `added` numbers the runs."""
        return self.table.read()

    def merge(self, answers: DataFrame) -> int:
        """The next version: what is held and the answers (term, items) on other terms, without those first in beyond `most`."""
        old = self.read()
        version = (self.table._listed() or [0])[-1] + 1
        new = answers.where("term IS NOT NULL").groupBy("term").agg(F.first("items").alias("items")).join(old.select("term"), "term", "left_anti").withColumn("added", F.lit(version))
        every = old.unionByName(new)
        sizes = {r.added: r.n for r in every.groupBy("added").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each run that is still held
        over = sum(sizes.values()) - self.most
        if over > 0:
            # new answers are read twice from here on
            every = stages.written(every, "cached")
            runs = sorted(sizes)
            while over >= sizes[runs[0]]:
                over -= sizes[runs.pop(0)]
            kept = every.where(F.col("added") > runs[0])
            rest = every.where(F.col("added") == runs[0])
            if over > 0:
                rest = audit.numbered(rest, ["term"], "_place").where(F.col("_place") >= over).drop("_place")
            every = kept.unionByName(rest.select(every.columns))
        return self.table.write(every)


class LookupStore:
    """A cache and the failed terms of a service, brought up to date by run()."""

    FAILED = "term string, failure string, attempts int, runs int"

    def __init__(self, spark: SparkSession, folder: str, most: int = MOST_TERMS):
        self.cache = TermCache(spark, f"{folder.rstrip('/')}/answers", most)
        self.failed = Snapshots(spark, f"{folder.rstrip('/')}/failures", self.FAILED)

    def run(self, terms: DataFrame, call: Callable[[list[services.Term]], services.Reply], policy: services.Policy = services.Policy()) -> DataFrame:
        """(term, items) of the distinct `terms` (term, context) that are answered, after asking for those without an answer: new ones, and failed ones.

        What is held and what is replied are written before they are used: nothing is asked twice, also if an executor is lost
        later on, and no later run takes the tables away. Failed terms, with the number of runs in which they failed,
        are in self.failed until they are answered.
        """
        held = self.cache.read().select("term", "items", F.lit(True).alias("_held"))
        context = F.first("context", ignorenulls=True) if "context" in terms.columns else F.lit(None)
        wanted = stages.written(terms.groupBy("term").agg(context.cast("string").alias("context")).join(held, "term", "left"), "wanted")
        asked = stages.written(services.ask(wanted.where("_held IS NULL"), call, policy), "asked")
        self.cache.merge(services.answered(asked))
        now, before = services.failures(asked).where("term IS NOT NULL"), self.failed.read()
        again = now.join(before.select("term", F.col("runs").alias("_runs")), "term", "left").select("term", "failure", "attempts", (F.coalesce("_runs", F.lit(0)) + 1).alias("runs"))
        rest = before.join(asked.select("term"), "term", "left_anti")  # failed in an earlier run, not asked for in this one
        self.failed.write(again.unionByName(rest))
        return wanted.where("_held").select("term", "items").unionByName(services.answered(asked))

    def lookup(self, terms: DataFrame, call: Callable[[list[services.Term]], services.Reply], backend: str, policy: services.Policy = services.Policy()) -> DataFrame:
        """The mapping of each term as mapping.lookup() gives it; the error of a failed term names the failure."""
        found = mapping.lookup(terms, self.run(terms, call, policy), backend)
        why = self.failed.read().select("term", F.col("failure").alias("_why"))
        return found.join(why, "term", "left").withColumn("error", F.when(F.col("error").isNotNull(), F.coalesce("_why", "error"))).drop("_why")
