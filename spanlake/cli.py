"""Command line: chunk, extract, map, audit, save. Tables are Parquet folders; exit code 2 says that input was refused."""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as tx
from .operators import audit, mapping, segment, tagger
from .plans import extraction, lookups
from .sources import artifacts, chunks

REFUSED = 2


def session() -> SparkSession:
    return SparkSession.builder.appName("spanlake").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _load(name: str | None, default):
    """An object named as module:attribute."""
    if not name:
        return default
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def chunk(spark: SparkSession, a: argparse.Namespace) -> int:
    """Documents (doc_id, text) as Parquet, or a folder of text files, to chunks."""
    if a.text:
        docs = chunks.discover(spark, a.input).select(F.col("path").alias("doc_id"), tx.normalize_markdown(F.col("value")).alias("text"))
    else:
        docs = spark.read.parquet(a.input)
    out = segment.with_overlap(extraction.chunked(docs.select("doc_id", "text"), segment.token_limit(a.max_tokens)))
    out.write.mode("overwrite").parquet(a.output)
    if a.files:
        out = spark.read.parquet(a.output)
        header = ["doc_id", "chunk_index", "char_start", "char_end", "token_count", "overlap_with_previous", "overlap_chars_with_previous"]
        artifacts.save_chunks(out, a.files, header, meta={"input": a.input, "max_tokens": segment.token_limit(a.max_tokens)}, overwrite=True)
    return 0


def extract(spark: SparkSession, a: argparse.Namespace) -> int:
    """Chunks to merged mentions; the tagger and both model calls are named as module:attribute."""
    labels = [r.l for r in spark.range(1).select(F.explode(tx.parse_labels(F.lit(a.labels))).alias("l")).collect()]
    models = extraction.Models(_load(a.tagger, None) or tagger.GazetteerTagger({x: [x] for x in labels}), labels, _load(a.refine, extraction.llm_calls.identity), _load(a.discover, extraction.llm_calls.silent))
    parts = segment.select_chunks(spark.read.parquet(a.input), a.chunk_index)
    meta = {"input": a.input, "labels": labels, "tagger": a.tagger or "gazetteer", "refine": a.refine, "discover": a.discover}
    extraction.master_mentions(parts, models, artifacts=a.artifacts, meta=meta).write.mode("overwrite").parquet(a.output)
    return 0


def map_terms(spark: SparkSession, a: argparse.Namespace) -> int:
    """Mentions to mapped mentions with an ontology table (ontology_id, ontology_label, ontology), and before it a service, named as module:attribute, whose answers and failed terms stay in a store."""
    service, store = None, None
    if a.service:
        if not a.store:
            raise SystemExit("--service needs --store")
        store, call = lookups.LookupStore(spark, a.store, a.most_terms), _load(a.service, None)
        service = lambda terms: store.lookup(terms, call, "service")
    mapped = extraction.mapped_mentions(audit.in_order(spark.read.parquet(a.input)), spark.read.parquet(a.ontology), service)
    mapped.write.mode("overwrite").parquet(a.output)
    out = spark.read.parquet(a.output)
    if a.csv:
        chunks.write_csv(out, a.csv, mapping.MAPPED_COLUMNS)
    refused = out.where("ontology_validation = 'invalid_demoted'").count()
    print(json.dumps({"refused": refused} | ({"failed_terms": store.failed.read().count()} if store else {})))
    return REFUSED if a.fail_on_invalid and refused else 0


def run_audit(spark: SparkSession, a: argparse.Namespace) -> int:
    """Mapped mentions to groups, counters and totals, one folder each."""
    raw = spark.read.parquet(a.input)
    from .plans import stages

    normal = stages.written(audit.validate_ontology(audit.normalize(audit.in_order(raw), a.kind)), "audit")
    for name, table in (("mentions", normal), ("groups", audit.groups(normal)), ("counters", audit.counters(normal)), ("totals", audit.totals(normal)), ("ontology", audit.ontology_counts(normal))):
        table.write.mode("overwrite").parquet(f"{a.output}/{name}")
    facts = F.struct(F.lit(datetime.now(timezone.utc).isoformat(timespec="seconds")).alias("created_at"), F.lit(a.input).alias("input_path"), F.lit(a.kind).alias("input_kind"))
    one = audit.totals(normal).select(F.struct("*").alias("totals")).crossJoin(audit.ontology_counts(normal).select(F.struct("*").alias("ontology")))  # a row each
    one.select(facts.alias("source"), "totals", F.struct("ontology").alias("validation")).write.mode("overwrite").json(f"{a.output}/summary")
    invalid = normal.where("ontology_validation = 'invalid'").count()
    print(json.dumps({"invalid": invalid}))
    return REFUSED if a.fail_on_invalid and invalid else 0


def save(spark: SparkSession, a: argparse.Namespace) -> int:
    """A JSON array of entities from standard input into its chunk's folder."""
    row = spark.createDataFrame([(a.paper, a.run, a.chunk, sys.stdin.read())], "paper_name string, run_id string, chunk_index int, payload string")
    row = audit.validate_payload(row).withColumn("error", F.coalesce("error", tx.path_segment_error(F.col("paper_name")), tx.path_segment_error(F.col("run_id")))).cache()
    error = row.first().error
    if error:
        print(error, file=sys.stderr)
        return REFUSED
    out: DataFrame = row.select("paper_name", "run_id", "chunk_index", F.size("entities").alias("entity_count"), "entities")
    chunks.write_mentions(out, a.output, ["paper_name", "run_id", "chunk_index"])
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="spanlake", description=__doc__)
    sub = p.add_subparsers(required=True)

    def command(name: str, f, *args: tuple[str, dict]) -> None:
        c = sub.add_parser(name, help=f.__doc__)
        c.set_defaults(command=f)
        for flag, options in args:
            c.add_argument(flag, **options)

    inout = [("input", {}), ("output", {})]
    command("chunk", chunk, *inout, ("--max-tokens", {"type": int}), ("--text", {"action": "store_true"}), ("--files", {}))
    command("extract", extract, *inout, ("--labels", {"required": True}), ("--tagger", {}), ("--refine", {}), ("--discover", {}), ("--artifacts", {}), ("--chunk-index", {"type": int, "action": "append"}))
    command("map", map_terms, *inout, ("--ontology", {"required": True}), ("--csv", {}), ("--service", {}), ("--store", {}), ("--most-terms", {"type": int, "default": lookups.MOST_TERMS}), ("--fail-on-invalid", {"action": "store_true"}))
    command("audit", run_audit, *inout, ("--kind", {"default": audit.MAPPED, "choices": [audit.MASTER, audit.MAPPED, audit.ENTITIES]}), ("--fail-on-invalid", {"action": "store_true"}))
    command("save", save, ("output", {}), ("--paper", {"required": True}), ("--run", {"required": True}), ("--chunk", {"type": int, "required": True}))
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    return a.command(spark or session(), a)
