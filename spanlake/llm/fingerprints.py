"""Document fingerprints: a canonical exact digest.

The canonical form is Unicode-normalised (NFKC), case-folded, and has its white space collapsed; its fingerprint is a
128-bit xxhash. Equal buckets are compared byte by byte: of texts that share a digest but not their canonical bytes,
each further one gets a suffix, so equal fingerprints mean equal canonical texts. The bytes of a bucket meet in an
aggregate with map-side combine, so thousands of copies are one row per task; texts whose digest is alone stay home,
by a Bloom filter of fixed size.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import by_bytes, column, map_batches, materialize, partitions


def canonical(text: str) -> bytes:
    """Canonical form in UTF-8; it is its own canonical form."""
    if text.isascii():
        return " ".join(text.lower().split()).encode()
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split()).encode("utf-8", "surrogatepass")


def xxh128(data: bytes) -> bytes:
    return xxhash.xxh3_128_digest(data)


def _texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [x or "" for x in column(batch, name).to_pylist()]


def _docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _key(digests: list[bytes]) -> np.ndarray:
    return np.array([int.from_bytes(d[:8].ljust(8, b"\0"), "little") for d in digests], np.uint64).view(np.int64)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[bytes], bytes] = xxh128) -> DataFrame:
    """(doc_id, digest binary, key long) of each row; a null text is an empty one."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [digest(canonical(x)) for x in _texts(batch)]
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(found, pa.binary()), pa.array(_key(found))], names=["doc_id", "digest", "key"])

    return map_batches(_docs(docs, id_col, text_col), work, "doc_id long, digest binary, key long", "text")


def collisions(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[bytes], bytes] = xxh128) -> DataFrame:
    """(digest, canonical_sha256, variant) of canonical texts that share a digest with other ones: the first has variant 0.

    `found` are the digests(). Only texts of digests that occur more than once (or pass the filter by mistake) move.
    """
    twice = found.groupBy("digest", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    words = bloom.build(twice, "key")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        forms = [canonical(x) for x in _texts(batch)]
        ds = [digest(x) for x in forms]
        keep = np.flatnonzero(bloom.contains(words, _key(ds))).tolist()
        return pa.RecordBatch.from_arrays([pa.array([ds[i] for i in keep], pa.binary()), pa.array([forms[i] for i in keep], pa.binary())], names=["digest", "form"]) if keep else None

    buckets = map_batches(_docs(docs, id_col, text_col), work, "digest binary, form binary", "text").groupBy("digest", "form").agg(F.count(F.lit(1)).alias("n"))
    forms = buckets.select("digest", F.sha2("form", 256).alias("canonical_sha256"))
    differ = forms.groupBy("digest").agg(F.collect_set("canonical_sha256").alias("all")).where("size(all) > 1")
    return differ.select("digest", F.posexplode(F.array_sort("all")).alias("variant", "canonical_sha256")).select("digest", "canonical_sha256", "variant")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[bytes], bytes] = xxh128) -> DataFrame:
    """(doc_id, fingerprint) of each row: the digest in hex, with a suffix where canonical texts of one digest differ."""
    found = materialize(digests(docs, id_col, text_col, digest), "digests")
    clash = materialize(collisions(docs, found, id_col, text_col, digest), "collisions", small=True)
    plain = found.select("doc_id", F.lower(F.hex("digest")).alias("fingerprint"))
    if clash.isEmpty():
        return plain

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        forms = [canonical(x) for x in _texts(batch)]
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array([digest(x) for x in forms], pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in forms])], names=["doc_id", "digest", "canonical_sha256"])

    exact = map_batches(_docs(docs, id_col, text_col), work, "doc_id long, digest binary, canonical_sha256 string", "text")
    exact = exact.join(clash, ["digest", "canonical_sha256"], "left")
    suffix = F.when(F.col("variant") > 0, F.concat(F.lit("-"), F.col("variant").cast("string"))).otherwise("")
    return exact.select("doc_id", F.concat(F.lower(F.hex("digest")), suffix).alias("fingerprint"))


def _cuts(keys: DataFrame, n: int, each: int = 20) -> np.ndarray:
    """At most n - 1 ascending bounds between ranges of about equal row counts, from a sample of about n * each keys."""
    total = keys.count()
    some = keys if total <= n * each else keys.sample(n * each / total, seed=7)
    have = np.sort(np.array([r.key for r in some.limit(3 * n * each).collect()], np.int64))  # bounded by the number of ranges
    return np.unique(have[np.linspace(0, len(have) - 1, n + 1).astype(int)[1:-1]]) if len(have) else have


def with_next(docs: DataFrame, work: Callable[[list[tuple]], pa.RecordBatch], schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows that `work` makes of (doc_id, text, next text) triples; the next document is that of the next id, after the last the first.

    Documents of one id stand in the order of their texts; those without an id come first. The documents are dealt
    over ranges of ids; the first of each range is also sent to the range before, so no task sees more than its share.
    """
    spark = docs.sparkSession
    rows = _docs(docs, id_col, text_col).select("doc_id", F.coalesce("doc_id", F.lit(-(2**63))).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = _cuts(rows.select("key"), max(2, 4 * partitions(spark)))

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, int] = {}
        for batch in batches:
            for k in column(batch, "key").to_pylist():
                b = int(np.searchsorted(cuts, k, side="right"))
                least[b] = min(k, least.get(b, k))
        yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.int32()), pa.array(list(least.values()), pa.int64())], names=["b", "k"])

    least = sorted((r.b, r.k) for r in rows.select("key").mapInArrow(firsts, "b int, k long").groupBy("b").agg(F.min("k").alias("k")).collect())  # one row per range
    heads, before = np.array([k for _, k in least], np.int64), np.array([b for b, _ in least[-1:] + least[:-1]], np.int32)

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        key = column(batch, "key").to_numpy()
        own = np.searchsorted(cuts, key, side="right").astype(np.int32)
        at = np.searchsorted(heads, key)
        at[at == len(heads)] = 0
        also = np.flatnonzero(heads[at] == key)
        take = np.r_[np.arange(len(key)), also]
        tail = np.r_[np.zeros(len(key), np.int32), np.ones(len(also), np.int32)]
        moved = batch.take(pa.array(take))
        return pa.RecordBatch.from_arrays([pa.array(np.r_[own, before[at[also]]].astype(np.int32)), pa.array(tail), column(moved, "key"), column(moved, "doc_id"), column(moved, "text")], names=["bucket", "tail", "key", "doc_id", "text"])

    dealt = map_batches(rows, deal, "bucket int, tail int, key long, doc_id long, text string", "text")
    dealt = dealt.repartition(max(partitions(spark), 1), "bucket").sortWithinPartitions("bucket", "tail", "key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at = None, None
        for batch in by_bytes(batches, "text"):
            out = []
            for b, tail, d, text in zip(*(column(batch, c).to_pylist() for c in ("bucket", "tail", "doc_id", "text"))):
                if b != at:
                    last, at = None, b
                if last is not None:
                    out.append((*last, text))
                last = None if tail else (d, text)
            if out:
                yield work(out)

    return dealt.mapInArrow(run, schema)


def edited(text: str, after: str) -> str:
    """The text with its last quarter of code points (rounded down) replaced by as many, or all, of the next text's first ones."""
    k = len(text) // 4
    return text[: len(text) - k] + after[:k]


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[bytes], bytes] = xxh128) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row.

    The digest is exact, so the likeness of two fingerprints is 1 if the canonical texts are the same bytes and else 0.
    Null and empty texts are alike; rows without an id come first and rows that share one follow the order of their texts,
    each a row of the result; other columns are not looked at, whatever their names, and an empty table gives an empty one.
    """

    def work(rows: list[tuple]) -> pa.RecordBatch:
        out = []
        form_at, form = None, b""
        for d, text, after in rows:
            mine = form if form_at == text else canonical(text)
            other = edited(text, after)
            changed = canonical(other) if other != text else mine
            form_at, form = after, canonical(after)
            out.append((d, len(text), hashlib.sha256(other.encode()).hexdigest(), digest(mine), digest(changed), float(mine == changed), float(mine == form)))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=["doc_id", "n_chars", "edited_sha256", "digest", "edited_digest", "near_edited", "near_next"])

    clash = materialize(collisions(docs, digests(docs, id_col, text_col, digest), id_col, text_col, digest), "collisions", small=True)
    found = with_next(docs, work, "doc_id long, n_chars long, edited_sha256 string, digest binary, edited_digest binary, near_edited double, near_next double", id_col, text_col)
    hexed = found.select("doc_id", "n_chars", "edited_sha256", F.lower(F.hex("digest")).alias("fingerprint"), F.lower(F.hex("edited_digest")).alias("edited_fingerprint"), "near_edited", "near_next")
    if clash.isEmpty():
        return hexed
    exact = fingerprints(docs, id_col, text_col, digest).groupBy("doc_id").agg(F.max("fingerprint").alias("exact"))
    return hexed.join(exact, "doc_id", "left").withColumn("fingerprint", F.coalesce("exact", "fingerprint")).drop("exact")
