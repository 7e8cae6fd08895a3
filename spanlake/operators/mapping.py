"""Ontology mapping: distinct terms, lookup cascades with fallback, enrichment, validation.

A lookup service (see services.py) becomes a table of (term, items), a join, and a left-anti join for what is still missing; terms are made
distinct before any lookup and joined back after. Small sides are left to Spark to broadcast by their measured size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import iri
from ..functions import text as tx
from ..plans import stages

#: Examples of a summary, columns of the mapped CSV.
EXAMPLES = 20
MAPPED_COLUMNS = [
    "extracted_text", "llm_label", "bioportal_prefLabel", "ontology_uri", "ontology", "mapping_backend", "mapping_error", "concept_mapping_provenance",
    "alignment_method", "ontology_validation", "ontology_validation_error", "chunk", "start", "end", "global_start", "global_end", "source_pass", "context", "source_chunk_path",
]


def valid_mentions(mentions: DataFrame, entity: str = "entity", fallback: str | None = None) -> DataFrame:
    """Mentions with a usable surface, sanitised."""
    surface = tx.sanitize_term(tx.first_filled(F.col(entity), *([F.col(fallback)] if fallback else [])))
    return mentions.withColumn(entity, surface).where(F.col(entity) != "")


def distinct_terms(mentions: DataFrame, seq: str = "seq") -> DataFrame:
    """(term, context) of each distinct surface; the context is that of its first mention."""
    # an aggregate with map-side combine, not a window: one term may hold a third of all mentions; texts are sanitised once a surface, not a mention
    first = mentions.groupBy("entity").agg(F.min_by("context", seq).alias("context"), F.min(seq).alias("seq"))
    terms = first.select(tx.sanitize_term(F.col("entity")).alias("term"), tx.term_context(F.col("context")).alias("context"), "seq").where("term != ''")
    return terms.groupBy("term").agg(F.min_by("context", "seq").alias("context"))


def uncached(terms: DataFrame, cache: DataFrame) -> DataFrame:
    """Terms that a table of earlier mappings doesn't have."""
    return terms.join(cache.select("term").distinct(), "term", "left_anti")


def first_hit(items: Column) -> Column:
    """Of candidates (ontology_id, ontology_label, ontology) in order: the first that has both id and label; null if none."""
    filled = lambda c: c.isNotNull() & (c != "")
    return F.try_element_at(F.filter(items, lambda x: filled(x["ontology_id"]) & filled(x["ontology_label"])), F.lit(1))


def lookup(terms: DataFrame, table: DataFrame, backend: str) -> DataFrame:
    """(term, ontology_id, ontology_label, ontology, error, mapping_backend) of each term, from a table of (term, items)."""
    hit = terms.select("term").join(table.select("term", first_hit(F.col("items")).alias("hit")), "term", "left")
    return hit.select("term", "hit.ontology_id", "hit.ontology_label", "hit.ontology", F.when(F.col("hit").isNull(), "No mapping found").alias("error"), F.lit(backend).alias("mapping_backend"))


#: A key of the fuzzy index is split, into so many parts, if it has more than this share of an average shuffle partition's rows, and so many rows at least.
_FREQUENT_SHARE, _FREQUENT_LEAST, _SPLITS = 16, 16, 8


def _short(most: int) -> int:
    """Labels of fewer characters can't be cut into most + 1 pieces that tell them apart."""
    return 3 * (most + 1)


def _deletions(c: Column, most: int) -> Column:
    """A text and what is left of it without up to `most` characters, but for nothing at all."""
    level, every = F.array(c), [F.array(c)]
    for _ in range(most):
        level = F.array_distinct(F.flatten(F.transform(level, lambda x: F.transform(F.filter(F.sequence(F.lit(0), F.length(x)), lambda i: i > 0), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x)))))))
        every.append(level)
    return F.array_remove(F.array_distinct(F.flatten(F.array(*every))), "")


def _pieces(most: int) -> Column:
    """A label's pieces, by its length and their number."""
    size = F.length("ontology_label")
    n = most + 1
    cut = lambda i: F.floor(size * i / n).cast("int")
    key = lambda i: F.concat_ws(":", size.cast("string"), F.lit(str(i)), F.substring(F.col("ontology_label"), cut(i) + 1, cut(i + 1) - cut(i)))
    return F.array(*[key(i) for i in range(n)])


def _probes(most: int) -> Column:
    """The pieces of all labels that a term may be near to: for each length and piece, shifted by `most` places or fewer."""
    n = most + 1
    spans = F.expr(
        f"flatten(flatten(transform(sequence(greatest({_short(most)}, length(term) - {most}), greatest({_short(most)}, length(term) + {most})), s -> transform(sequence(0, {most}), i -> "
        f"transform(sequence(-{most}, {most}), d -> named_struct('s', s, 'i', i, 'at', cast(floor(s * i / {n}) AS int) + d, 'n', cast(floor(s * (i + 1) / {n}) - floor(s * i / {n}) AS int)))))))"
    )
    inside = F.filter(spans, lambda w: (w["at"] >= 0) & (w["at"] + w["n"] <= F.length("term")))
    return F.array_distinct(F.transform(inside, lambda w: F.concat_ws(":", w["s"].cast("string"), w["i"].cast("string"), F.substring(F.col("term"), w["at"] + 1, w["n"]))))


def fuzzy_index(ontology: DataFrame, most: int = 2) -> DataFrame:
    """(key, kind, part, splits, ontology_id, ontology_label, ontology): the labels by keys that they share with every term within `most` edits.

    A label of fewer than 3 (most + 1) characters has what is left of it without up to `most` characters (kind d): texts within that many edits have
    one such rest in common. A longer one has its most + 1 pieces (kind p), of which at least one is unharmed and off its place by
    `most` at most. No key is empty. The rows of a frequent key are dealt over `splits` parts. Write the index down to use it again.
    """
    o = ontology.where("ontology_id != '' AND ontology_label != ''").select("ontology_id", "ontology_label", "ontology")
    short = F.length("ontology_label") < _short(most)
    rows = o.select("*", F.when(short, "d").otherwise("p").alias("kind"), F.explode(F.when(short, _deletions(F.col("ontology_label"), most)).otherwise(_pieces(most))).alias("key"))
    rows = stages.written(rows, "keys")  # counted for its frequent keys, and read
    parts = int(o.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = rows.count() / (_FREQUENT_SHARE * parts)
    often = rows.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max(many, _FREQUENT_LEAST)).drop("_n")  # fewer than _FREQUENT_SHARE * parts keys
    marked = rows.join(F.broadcast(often.withColumn("_often", F.lit(True))), ["kind", "key"], "left")
    splits = F.when(F.col("_often"), _SPLITS).otherwise(1)
    return marked.select("key", "kind", F.pmod(F.xxhash64("ontology_label", "ontology_id"), splits).cast("int").alias("part"), splits.alias("splits"), "ontology_id", "ontology_label", "ontology")


def near_terms(terms: DataFrame, index: DataFrame, most: int = 2) -> DataFrame:
    """(term, ontology_id, ontology_label, ontology, edits) of all labels within `most` edits of a term, by a fuzzy_index() for as many.

    Only pairs of two texts of at most `most` characters may have no key in common; see exact_then_fuzzy().
    """
    reach = F.length("term") < _short(most) + most
    keyed = lambda keys, kind, where: terms.where(where & (F.length("term") > 0)).select("term", F.explode(keys).alias("key"), F.lit(kind).alias("kind"))
    probes = keyed(_deletions(F.col("term"), most), "d", reach).unionByName(keyed(_probes(most), "p", F.length("term") >= _short(most) - most))
    splits = index.where("splits > 1").select("kind", "key", "splits").distinct()  # a bounded number of keys
    probes = probes.join(F.broadcast(splits), ["kind", "key"], "left")
    probes = probes.select("term", "kind", "key", F.explode(F.sequence(F.lit(0), F.coalesce("splits", F.lit(1)) - 1)).alias("part"))
    met = probes.join(index.drop("splits"), ["kind", "key", "part"]).select("term", "ontology_id", "ontology_label", "ontology")
    found = met.withColumn("edits", F.levenshtein("term", "ontology_label")).where(F.col("edits") <= most)
    return found.distinct()


def exact_then_fuzzy(terms: DataFrame, ontology: DataFrame, most: int = 2, index: DataFrame | None = None) -> DataFrame:
    """(term, ontology_id, ontology_label, ontology, exact_match): the label that equals a term, else the nearest within `most` edits.

    `ontology` has ontology_id, ontology_label, ontology; `index` is its fuzzy_index(), made anew where it isn't given. Equal labels join on the label;
    what is left meets labels on keys. No term is held against all labels. Ties: fewest edits, then label, then id.
    """
    o = ontology.where("ontology_id != '' AND ontology_label != ''").select("ontology_id", "ontology_label", "ontology")
    exact = terms.select("term").join(o, terms.term == o.ontology_label).withColumn("edits", F.lit(0)).withColumn("exact_match", F.lit(True))
    left = terms.select("term").join(exact.select("term").distinct(), "term", "left_anti")
    near = near_terms(left, fuzzy_index(ontology, most) if index is None else index, most)
    # texts of at most `most` characters are all near each other, and may share no key: the least such label stands for those that are as far as can be
    least = o.where(F.length("ontology_label") <= most).agg(F.min(F.struct("ontology_label", "ontology_id", "ontology")).alias("o")).where("o IS NOT NULL")
    tiny = left.where(F.length("term").between(1, most)).join(F.broadcast(least), F.lit(True)).select("term", "o.ontology_id", "o.ontology_label", "o.ontology")  # one row
    near = near.unionByName(tiny.withColumn("edits", F.levenshtein("term", "ontology_label"))).withColumn("exact_match", F.lit(False))
    both = exact.select("term", "ontology_id", "ontology_label", "ontology", "edits", "exact_match").unionByName(near)
    best = both.groupBy("term").agg(F.min(F.struct("edits", "ontology_label", "ontology_id", "ontology", "exact_match")).alias("b"))
    return best.select("term", "b.ontology_id", "b.ontology_label", "b.ontology", "b.exact_match")


def succeeded() -> Column:
    filled = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    return filled("ontology_id") & filled("ontology_label") & ~F.coalesce(filled("error"), F.lit(False))


def with_fallback(first: DataFrame, second: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Mappings of a first lookup; its misses go to the second, whose result counts where it succeeds, per term."""
    ok = F.coalesce(succeeded(), F.lit(False))
    misses = first.where(~ok)
    names = [c for c in first.columns if c != "term"]
    again = second(misses.select("term")).where(F.coalesce(succeeded(), F.lit(False)))
    again = again.select("term", F.struct(*names).alias("again"))
    merged = misses.join(again, "term", "left").select("term", *[F.when(F.col("again").isNotNull(), F.col(f"again.{c}")).otherwise(F.col(c)).alias(c) for c in names])
    return first.where(ok).unionByName(merged)


def enrich(mentions: DataFrame, mappings: DataFrame, backend: str = "auto") -> DataFrame:
    """Mentions with the mapping of their sanitised surface; all else stays. Unmapped ones have null mapping columns."""
    renamed = {"entity": "extracted_text", "label": "llm_label"}
    m = mentions.withColumn("entity", tx.sanitize_term(F.col("entity"))).withColumnsRenamed(renamed)
    ok = F.coalesce(succeeded(), F.lit(False))
    out = m.join(mappings.withColumnRenamed("term", "extracted_text"), "extracted_text", "left")
    cols = {
        "bioportal_prefLabel": F.when(ok, F.col("ontology_label")),
        "ontology_uri": F.when(ok, F.col("ontology_id")),
        "ontology": F.when(ok, F.col("ontology")),
        "mapping_backend": tx.first_filled(F.col("mapping_backend"), F.lit(backend)),
        "mapping_error": F.col("error"),
        "concept_mapping_provenance": F.when(ok, "tool").otherwise("unmapped"),
        "alignment_method": F.lit("direct_tool_call"),
    }
    return out.withColumns(cols).drop("ontology_id", "ontology_label", "error")


def mapping_problem(strict: bool = True) -> Column:
    """Why a mapped mention's identifier is refused; null where it isn't, or where there is none."""
    uri = tx.blank_to_null(F.col("ontology_uri"))
    made_up = F.lower(tx.strip(F.coalesce("concept_mapping_provenance", F.lit("")))) == "llm_knowledge"
    problem = F.when(made_up, "llm_knowledge_rejected")
    if strict:
        problem = problem.when(~iri.well_formed(F.col("ontology_uri")), "malformed_iri")
    return F.when(uri.isNotNull(), problem)


def demote(enriched: DataFrame, strict: bool = True) -> DataFrame:
    """Refused mappings taken back: null mapping columns, the reason in ontology_validation_error and, once, in mapping_error."""
    out = enriched.withColumn("_why", mapping_problem(strict)).withColumn("_had", tx.blank_to_null(F.col("ontology_uri")).isNotNull())
    bad, error = F.col("_why").isNotNull(), tx.blank_to_null(F.col("mapping_error"))
    noted = F.when(error.isNull(), F.col("_why")).when(F.contains(error, F.col("_why")), error).otherwise(F.concat_ws(" | ", error, F.col("_why")))
    cols = {
        "ontology_validation": F.when(bad, "invalid_demoted").when(F.col("_had"), "valid").otherwise("not_mapped"),
        "ontology_validation_error": F.col("_why"),
        "mapping_error": F.when(bad, noted).otherwise(F.col("mapping_error")),
        "refused_uri": F.when(bad, F.col("ontology_uri")),
        "refused_ontology": F.when(bad, F.col("ontology")),
        "concept_mapping_provenance": F.when(bad, "unmapped").otherwise(F.col("concept_mapping_provenance")),
        "alignment_method": F.when(bad, "validation_failed").otherwise(F.col("alignment_method")),
    } | {c: F.when(~bad, F.col(c)) for c in ("bioportal_prefLabel", "ontology_uri", "ontology")}
    return out.withColumns(cols).drop("_why", "_had")


def validation_summary(demoted: DataFrame, strict: bool = True, seq: str = "seq") -> DataFrame:
    """One row: valid_mapped, unmapped (demoted ones too), invalid_demoted, invalid_by_reason, and the first examples of invalid ones."""
    state = F.col("ontology_validation")
    counts = demoted.agg(
        F.count_if(state == "valid").alias("valid_mapped"), F.count_if(state.isin("not_mapped", "invalid_demoted")).alias("unmapped"), F.count_if(state == "invalid_demoted").alias("invalid_demoted")
    )
    bad = demoted.where(state == "invalid_demoted")
    reasons = bad.groupBy("ontology_validation_error").count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("ontology_validation_error", "count")))).alias("invalid_by_reason"))
    first = bad.orderBy(seq).limit(EXAMPLES).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), "extracted_text", F.col("refused_uri").alias("ontology_uri"), F.col("refused_ontology").alias("ontology"), F.col("ontology_validation_error").alias("reason")))), lambda x: x.dropFields("s")).alias("invalid_examples"))
    return counts.crossJoin(reasons).crossJoin(first).withColumn("strict_iri_validation", F.lit(strict))  # one row each


