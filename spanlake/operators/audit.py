"""Audit of extracted mentions: normal form, identifier and span validation, groups, statistics."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import iri
from ..functions import text as tx
from ..plans import stages

#: Kinds of input, contexts of a group, and what stands for a missing value in each count.
MASTER, MAPPED, ENTITIES = "master_extracted_entities", "ontology_mapped_entities", "entities"
GROUP_CONTEXTS = 10
MISSING = {"label": "Unknown", "source_pass": "unknown", "chunk": "unknown", "mapping_backend": "none", "concept_mapping_provenance": "missing"}
CANONICAL = [
    "id", "entity", "label", "context", "sentence", "chunk", "start", "end", "global_start", "global_end", "source_pass", "source_chunk_path", "masked",
    "ontology_id", "ontology_label", "ontology", "concept_mapping_provenance", "alignment_method", "mapping_backend", "mapping_error",
]
_ALIASES = {"extracted_text", "llm_label", "bioportal_prefLabel", "ontology_uri"}


def input_kind(columns: list[str]) -> str:
    """Kind of a document by its top-level columns."""
    if "master_entities" in columns:
        return MASTER
    if "entities" in columns:
        return MAPPED if "backend" in columns else ENTITIES
    raise ValueError("no column master_entities or entities")


def numbered(df: DataFrame, order: list, target: str = "seq") -> DataFrame:
    """`df` with numbers 0, 1, .. in an order of columns, without one task that numbers all rows.

    Rows are dealt over ranges of the order and numbered within them; the numbered rows are written, as the ranges are sampled
    and may come out otherwise when made again; each range goes on from the count of those before it.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    rows = stages.written(dealt.withColumn("_n", local), "numbered")
    sizes = rows.groupBy("_part").agg(F.max("_n").alias("_size"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_size")
    out = rows.join(F.broadcast(before), "_part")  # one row per range
    return out.withColumn(target, (F.col("_n") + F.col("_before") - 1).cast("long")).drop("_part", "_n", "_before")


#: Columns by which mentions follow each other, as far as they are there: document, chunk, place, and the order in which they came.
ORDER = ("doc_id", "source_file", "chunk", "global_start", "start", "seq")


def in_order(mentions: DataFrame) -> DataFrame:
    """Mentions with seq numbered in the order of their documents; those without a place come last in their chunk, equal ones by a hash."""
    have = [c for c in ORDER if c in mentions.columns]
    return numbered(mentions, [F.col(c).asc_nulls_last() for c in have] + [F.xxhash64(*[F.col(c).cast("string") for c in mentions.columns])], "_seq").drop("seq").withColumnRenamed("_seq", "seq")


def dense_ids(df: DataFrame, seq: str, target: str = "id") -> DataFrame:
    """mention_000000, .. in the order of `seq`."""
    return numbered(df, [seq], "_number").withColumn(target, F.format_string("mention_%06d", "_number")).drop("_number")


def normalize(raw: DataFrame, kind: str, seq: str = "seq", ids: bool = True) -> DataFrame:
    """Mentions in canonical columns; rows without a surface go. Other columns are kept as text in the map source_fields. Numbering all rows can be left out."""
    have = set(raw.columns)

    def pick(*names: str) -> Column:
        found = [tx.blank_to_null(F.col(n).cast("string")) for n in names if n in have]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    as_is = lambda n: F.col(n) if n in have else F.lit(None).cast("string")
    uri = pick("ontology_id", "ontology_uri")
    absent = ("unmapped", "direct_tool_call") if kind == MAPPED else ("skipped", "skipped")
    context = tx.blank_to_null(tx.clean_text(pick("context", "sentence")))
    cols = {
        "entity": tx.clean_text(pick("entity", "extracted_text", "text")),
        "label": tx.blank_to_null(tx.clean_text(pick("label", "llm_label", "type"))),
        "context": context,
        "sentence": context,
        "ontology_id": uri,
        "ontology_label": pick("ontology_label", "bioportal_prefLabel"),
        "concept_mapping_provenance": F.coalesce(pick("concept_mapping_provenance"), F.when(uri.isNotNull(), "tool").otherwise(absent[0])),
        "alignment_method": F.coalesce(pick("alignment_method"), F.when(uri.isNotNull(), "direct_tool_call").otherwise(absent[1])),
    }
    rest = sorted(have - set(CANONICAL) - _ALIASES - {seq})
    extra = F.map_filter(F.create_map(*[x for n in rest for x in (F.lit(n), F.col(n).cast("string"))]), lambda k, v: v.isNotNull()) if rest else F.lit(None).cast("map<string,string>")
    out = raw.select(F.col(seq), *[cols.get(n, as_is(n)).alias(n) for n in CANONICAL if n != "id"], extra.alias("source_fields")).where("entity != ''")
    return dense_ids(out, seq) if ids else out


def iri_problem() -> Column:
    """Why a mention's identifier is refused; null where it is sound, or rightly absent."""
    absent = tx.blank_to_null(F.col("ontology_id")).isNull()
    origin = F.lower(tx.strip(F.coalesce("concept_mapping_provenance", F.lit(""))))
    return (
        F.when(absent & origin.isin("unmapped", "skipped"), F.lit(None).cast("string"))
        .when(absent, "missing_ontology_id")
        .when(origin == "llm_knowledge", "llm_knowledge_rejected")
        .when(~iri.well_formed(F.col("ontology_id")), "malformed_iri")
    )


def validate_ontology(mentions: DataFrame) -> DataFrame:
    """ontology_validation (valid, not_mapped, invalid) and ontology_validation_error of each mention."""
    why = iri_problem()
    state = F.when(why.isNotNull(), "invalid").when(tx.blank_to_null(F.col("ontology_id")).isNotNull(), "valid").otherwise("not_mapped")
    return mentions.withColumns({"ontology_validation": state, "ontology_validation_error": why})


def ontology_counts(validated: DataFrame) -> DataFrame:
    """One row: valid_mapped, invalid, unmapped, skipped."""
    state, origin = F.col("ontology_validation"), F.col("concept_mapping_provenance")
    loose = state == "not_mapped"
    return validated.agg(
        F.count_if(state == "valid").alias("valid_mapped"), F.count_if(state == "invalid").alias("invalid"), F.count_if(loose & (origin == "unmapped")).alias("unmapped"), F.count_if(loose & (origin == "skipped")).alias("skipped")
    )


#: Characters of a text whose mentions are checked together.
BLOCK_CHARS = 1 << 16


@F.arrow_udf(T.ArrayType(T.BooleanType()))
def _agree(text: pa.Array, spans: pa.Array) -> pa.Array:
    offsets, values = spans.offsets.to_pylist(), spans.values
    starts, ends, entities = (values.field(n).to_pylist() for n in ("s", "e", "entity"))
    out = []
    for i, whole in enumerate(text.to_pylist()):
        places = range(offsets[i], offsets[i + 1])
        out.append([None] * len(places) if whole is None else [0 <= starts[k] <= ends[k] <= len(whole) and whole[starts[k] : ends[k]] == entities[k] for k in places])
    return pa.array(out, pa.list_(pa.bool_()))


def span_agreement(mentions: DataFrame, texts: DataFrame, keys: list[str], start: str, end: str, target: str) -> DataFrame:
    """`mentions` with `target`: whether the text (column body of `texts`) at [start, end) is the entity; false for a span outside the text; null where anything is unknown.

    Mentions of a block of a text are nested and meet it once: a text isn't copied for each mention, nor looked through from its begin.
    """
    names = mentions.columns
    known = F.col(start).isNotNull() & F.col(end).isNotNull()
    rows = F.struct(F.col(start).cast("long").alias("s"), F.col(end).cast("long").alias("e"), F.col("entity").alias("entity"), F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"))
    nested = mentions.where(known).groupBy(*keys, F.floor(F.col(start) / BLOCK_CHARS).alias("_block")).agg(F.collect_list(rows).alias("_rows"))
    met = nested.join(texts.select(*keys, F.col("body").alias("_body")), keys, "left")
    told = met.select(F.explode(F.arrays_zip(F.col("_rows"), _agree(F.col("_body"), F.transform("_rows", lambda x: x.dropFields("row"))).alias("ok"))).alias("x"))
    told = told.select("x._rows.row.*", F.col("x.ok").alias(target))
    return told.unionByName(mentions.where(~known).withColumn(target, F.lit(None).cast("boolean")))


def validate_spans(mentions: DataFrame, chunks: DataFrame | None = None, sources: DataFrame | None = None, chunk_keys: list[str] | None = None, source_keys: list[str] | None = None) -> DataFrame:
    """span_validation of each mention: valid if the chunk's text or the source's agrees, invalid if either disagrees, else not_checked.

    `chunks` and `sources` have a column body, and a row for each of their keys. An empty source text counts as none.
    """
    out, names = mentions, mentions.columns
    for texts, keys, start, end, target in ((chunks, chunk_keys, "start", "end", "_local"), (sources, source_keys, "global_start", "global_end", "_whole")):
        if texts is None:
            out = out.withColumn(target, F.lit(None).cast("boolean"))
            continue
        body = F.col("body") if target == "_local" else tx.blank_to_null(F.col("body"))
        out = span_agreement(out, texts.select(*keys, body.alias("body")), keys, start, end, target)
    yes = lambda c, v: F.coalesce(F.col(c) == v, F.lit(False))
    state = F.when(yes("_local", True) | yes("_whole", True), "valid").when(yes("_local", False) | yes("_whole", False), "invalid").otherwise("not_checked")
    return out.withColumn("span_validation", state).select(*[F.col(f"`{n}`") for n in names if n != "span_validation"], "span_validation")


def _keys(df: DataFrame) -> DataFrame:
    return df.withColumns({"_surface": F.lower(tx.strip(F.col("entity"))), "_label": tx.strip(F.coalesce("label", F.lit("")))})


def canonical_surfaces(mentions: DataFrame, seq: str = "seq") -> DataFrame:
    """(surface, label, entity): the most frequent spelling of each group, the first seen of equals.

    Spellings are counted before groups are formed, so a hot group is a few rows by then.
    """
    per = _keys(mentions).groupBy("_surface", "_label", "entity").agg(F.count(F.lit(1)).alias("n"), F.min(seq).alias("first"))
    return per.groupBy("_surface", "_label").agg(F.max_by("entity", F.struct("n", (-F.col("first")).alias("f"))).alias("entity")).withColumnsRenamed({"_surface": "surface", "_label": "label"})


def best_mappings(mentions: DataFrame, seq: str = "seq") -> DataFrame:
    """(surface, label, best): the mapping of each group by provenance (tool, unmapped, others), then an identifier at all, then first seen."""
    origin = F.col("concept_mapping_provenance")
    rank = F.struct(F.when(origin == "tool", 100).when(origin == "unmapped", 10).otherwise(0).alias("p"), tx.blank_to_null(F.col("ontology_id")).isNotNull().cast("int").alias("h"), (-F.col(seq)).alias("f"))
    best = F.max_by(F.struct("ontology_id", "ontology_label", "ontology", "concept_mapping_provenance", "alignment_method", "mapping_backend"), rank)
    return _keys(mentions).groupBy("_surface", "_label").agg(best.alias("best")).withColumnsRenamed({"_surface": "surface", "_label": "label"})


def groups(mentions: DataFrame, seq: str = "seq", with_ids: bool = False) -> DataFrame:
    """One row for each lower-cased surface and label: entity, mention_count, chunks, source_passes, first contexts, best mapping, judge scores.

    mention_ids (with_ids) grow with the group: ask for them only where no group holds a large share of all rows.
    """
    m = _keys(mentions)
    keys = ["_surface", "_label"]
    ctx = m.select(*keys, seq, F.coalesce(tx.blank_to_null(F.col("context")), tx.blank_to_null(F.col("sentence")) if "sentence" in m.columns else F.lit(None)).alias("c")).where("c IS NOT NULL")
    ctx = ctx.groupBy(*keys, "c").agg(F.min(seq).alias("first"))
    top = F.row_number().over(Window.partitionBy(*keys).orderBy("first"))
    ctx = ctx.withColumn("r", top).where(F.col("r") <= GROUP_CONTEXTS).groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "c"))), lambda x: x["c"]).alias("contexts"))
    passes = m.where("source_pass != ''").groupBy(*keys, "source_pass").count().groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source_pass", "count")))).alias("source_passes"))
    chunks = m.where("chunk IS NOT NULL AND chunk != ''").select(*keys, F.col("chunk").cast("string")).distinct().groupBy(*keys).agg(F.array_sort(F.collect_list("chunk")).alias("chunks"))
    judge = F.col("source_fields").getItem("judge_score").try_cast("double") if "source_fields" in m.columns else F.lit(None).cast("double")
    agg = [F.count(F.lit(1)).alias("mention_count"), F.max(judge).alias("judge_score_max"), F.round(F.avg(judge), 3).alias("judge_score_avg"), F.min(judge).alias("judge_score_min")]
    if with_ids:
        agg.append(F.transform(F.array_sort(F.collect_list(F.struct(seq, "id"))), lambda x: x["id"]).alias("mention_ids"))
    out = m.groupBy(*keys).agg(*agg)
    renamed = {"surface": "_surface", "label": "_label"}
    for side in (canonical_surfaces(mentions, seq).withColumnsRenamed(renamed), best_mappings(mentions, seq).withColumnsRenamed(renamed), ctx, passes, chunks):
        out = out.join(side, keys, "left")
    out = out.withColumn("label", tx.blank_to_null(F.col("_label"))).select("*", "best.*").drop("best", *keys)
    return out.orderBy(F.col("mention_count").desc(), "entity")


def counters(mentions: DataFrame, seq: str = "seq") -> DataFrame:
    """(counter, value, n, first): counts by label, pass, chunk, backend and provenance, in one pass; most common first, first seen of equals."""
    pairs = F.array(*[F.struct(F.lit(c).alias("counter"), F.coalesce(tx.blank_to_null(F.col(c).cast("string")), F.lit(v)).alias("value")) for c, v in MISSING.items()])
    out = mentions.select(seq, F.explode(pairs).alias("p")).groupBy("p.counter", "p.value").agg(F.count(F.lit(1)).alias("n"), F.min(seq).alias("first"))
    return out.orderBy("counter", F.col("n").desc(), "first")


def totals(mentions: DataFrame) -> DataFrame:
    """One row: mentions, distinct surfaces, groups, mapped and unmapped mentions, mentions per surface."""
    m = _keys(mentions)
    mapped = F.count_if(tx.blank_to_null(F.col("ontology_id")).isNotNull())
    surfaces = F.countDistinct(F.lower(tx.blank_to_null(F.col("entity"))))
    out = m.agg(F.count(F.lit(1)).alias("total_entity_mentions"), surfaces.alias("unique_surface_forms"), F.countDistinct("_surface", "_label").alias("unique_entity_label_groups"), mapped.alias("mapped_mentions"))
    n = F.col("total_entity_mentions")
    return out.withColumns({"unmapped_or_skipped_mentions": n - F.col("mapped_mentions"), "mentions_per_unique_surface": F.when(F.col("unique_surface_forms") > 0, F.bround(n / F.col("unique_surface_forms"), 2)).otherwise(0.0)})


def validate_payload(rows: DataFrame, column: str = "payload") -> DataFrame:
    """`rows` with entities (array of entity, label, context; other keys dropped, long contexts cut) and error (null if sound) of a JSON payload as text."""
    shape = F.try_parse_json(F.col(column))
    kind = lambda v: F.coalesce(F.schema_of_variant(v), F.lit("VOID"))
    raw = F.when(F.startswith(kind(shape), F.lit("ARRAY")), F.try_variant_get(shape, "$", "array<variant>"))
    fields = ["entity", "label", "context"]
    of = lambda x, f: F.try_variant_get(x, f"$.{f}", "variant")

    def problem(x: Column, i: Column) -> Column:
        """The first fault of an entity: no object, then what is missing, then the first field that is no text or blank."""
        missing = F.array_join(F.array_compact(F.array(*[F.when(of(x, f).isNull(), F.lit(f)) for f in fields])), ",")
        wrong = F.coalesce(*[F.when(kind(of(x, f)) != "STRING", F.lit(f"{f} is not text")).when(tx.strip(F.try_variant_get(x, f"$.{f}", "string")) == "", F.lit(f"blank {f}")) for f in fields])
        fault = F.when(~F.startswith(kind(x), F.lit("OBJECT")), "not an object").when(missing != "", F.concat(F.lit("missing "), missing)).otherwise(wrong)
        return F.when(fault.isNotNull(), F.concat(F.lit("entity "), i.cast("string"), F.lit(": "), fault))

    first = F.try_element_at(F.filter(F.transform(raw, problem), lambda x: x.isNotNull()), F.lit(1))
    error = F.when(raw.isNull(), "not a JSON array").otherwise(first)
    most = tx.PAYLOAD_CONTEXT_CHARS
    cut = lambda c: F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("…"))).otherwise(c)
    text = lambda x, f: F.try_variant_get(x, f"$.{f}", "string")
    kept = F.transform(raw, lambda x: F.struct(text(x, "entity").alias("entity"), text(x, "label").alias("label"), cut(text(x, "context")).alias("context")))
    return rows.withColumn("error", error).withColumn("entities", F.when(F.col("error").isNull(), kept))
