"""Labelled training rows: which ids may be learned from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold

#: A classifier is fitted on at most so many labelled documents, each of at most so many bytes.
SAMPLE_DOCS, SAMPLE_DOC_BYTES = 8000, 1 << 14


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int = SAMPLE_DOCS, doc_bytes: int = SAMPLE_DOC_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, y) of at most `most` documents outside the held-out fold, the first in the order of a hash of the id.

    The sample is a bound on what fitting costs, not on what is scored. An id with two labels counts once, with the
    larger; null labels, ids and texts are left out; of documents that share an id, all are taken.
    """
    ids = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & (crc_fold(id_col, folds) != held_out))
    ids = ids.groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(label).cast("int").alias("y")).orderBy(F.xxhash64("_id"), "_id").limit(most)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(f"text IS NOT NULL AND octet_length(text) <= {doc_bytes}")
    return texts.join(F.broadcast(ids), texts.doc_id == ids["_id"]).select("doc_id", "text", "y")  # at most `most` rows of two numbers
