"""The corpus pipeline: quality classifier, line dedup, near-dedup, decontamination, tokenization, in that order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the docs
of the next stage. All stages but the last return the columns of `documents`; the last adds n_tokens, ids and parity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm import decontaminate, lines, pieces, quality, simhash
from spanlake.llm.common import materialize, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, learned from the labels outside its held-out fold, accepts. Null and empty texts are scored like others; repeated rows go or stay together."""
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat one elsewhere; n_chars follows the text. No document goes, also if nothing is left of it; null texts stay null."""
    free = [n for n in (f"_lines_{i}" for i in range(len(docs.columns) + 2)) if n not in docs.columns]
    out = lines.deduplicate(docs, counts=(free[0], free[1]))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least doc_id. Null and empty texts are one group; rows without an id stay, repeated rows go or stay together."""
    return simhash.survivors(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no more than a stray word in twenty of benchmark passages. Null and empty texts, and rows without an id, stay; rows that share an id go together."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its token ids, their number, and whether sentencepiece makes the same of it. Null and empty texts have none; repeated rows come back as often."""
    return pieces.encode(docs, pieces.load()).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: A learned classifier and a tokenizer are not SQL; the stages are held against brute-force versions in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
