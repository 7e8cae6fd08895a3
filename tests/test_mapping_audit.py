import json
import random

import pytest
from pyspark.sql import functions as F

from spanlake.operators import audit, llm_calls, mapping, tagger
from spanlake.plans import stages


def test_terms_lookup_and_fallback(spark):
    m = spark.createDataFrame([(0, " a ", "c0"), (1, "a", "c1"), (2, "b", None), (3, "​", "x"), (4, None, "x"), (5, "zed", "c" * 300)], "seq int, entity string, context string")
    terms = mapping.distinct_terms(m)
    assert {(r.term, r.context) for r in terms.collect()} == {("a", "c0"), ("b", None), ("zed", "c" * 200)}
    assert mapping.uncached(terms, terms.where("term = 'a'")).count() == 2
    table = spark.createDataFrame([("a", [("", "no id", "o"), ("ID:1", "A", "o"), ("ID:2", "A2", "o")]), ("b", [("ID:3", None, "o")])], "term string, items array<struct<ontology_id:string,ontology_label:string,ontology:string>>")
    first = mapping.lookup(terms, table, "local")
    got = {r.term: (r.ontology_id, r.error, r.mapping_backend) for r in first.collect()}
    assert got == {"a": ("ID:1", None, "local"), "b": (None, "No mapping found", "local"), "zed": (None, "No mapping found", "local")}
    asked = []

    def second(misses):
        asked.extend(sorted(r.term for r in misses.collect()))
        rows = [("b", "ID:9", "B", "r", None, "remote"), ("zed", None, None, None, "nothing", "remote")]
        return spark.createDataFrame(rows, first.schema).join(misses.select("term"), "term", "left_semi")

    out = {r.term: (r.ontology_id, r.mapping_backend, r.error) for r in mapping.with_fallback(first, second).collect()}
    assert asked == ["b", "zed"]
    assert out == {"a": ("ID:1", "local", None), "b": ("ID:9", "remote", None), "zed": (None, "local", "No mapping found")}


def test_exact_then_fuzzy(spark):
    labels = ["cortex", "cortes", "hippocampus", "ab", "brain stem", "x" * 30]
    onto = spark.createDataFrame([(f"O:{i}", x, "o") for i, x in enumerate(labels)], "ontology_id string, ontology_label string, ontology string")
    words = ["cortex", "cortez", "hipocampus", "hippocampuses", "abc", "a", "brainstem", "brain  stem", "nothing", "x" * 28, "x" * 27]
    terms = spark.createDataFrame([(w, None) for w in words], "term string, context string")

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    want = {}
    for w in words:
        best = min(((distance(w, x), x) for x in labels), default=None)
        if best and best[0] <= 2:
            want[w] = (best[1], best[0] == 0)
    got = {r.term: (r.ontology_label, r.exact_match) for r in mapping.exact_then_fuzzy(terms, onto).collect()}
    assert got == want


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_fuzzy_terms_of_all_lengths(spark, most, monkeypatch):
    monkeypatch.setattr(mapping, "_FREQUENT_SHARE", 10**6)
    monkeypatch.setattr(mapping, "_FREQUENT_LEAST", 3)
    rng = random.Random(most)
    word = lambda n: "".join(rng.choices("abé漢", k=n))
    labels = sorted({word(rng.choice([1, 1, 2, 2, 3, 4, 6, 8, 9, 10, 12, 14])) for _ in range(140)})
    words = sorted({word(rng.randint(1, 14)) for _ in range(80)} | {x[:-1] + "b" for x in labels[::3]} | {"a" + x[2:] for x in labels[::4]} | {"x", "xy", "xyz", ""})
    onto = spark.createDataFrame([(f"O:{i % 7}", x, None) for i, x in enumerate(labels)] + [("", "no id", "o"), ("O:1", "", "o")], "ontology_id string, ontology_label string, ontology string")
    terms = spark.createDataFrame([(w,) for w in words], "term string").repartition(3)
    index = stages.written(mapping.fuzzy_index(onto, most), "index")
    assert index.where("key = ''").count() == 0 and index.where("splits > 1").count() > 0  # a few letters make frequent keys
    ids = {x: f"O:{i % 7}" for i, x in enumerate(labels)}
    want = {}
    for w in words:
        best = min(((edits(w, x), x) for x in labels), default=None)
        if w and best and best[0] <= most:
            want[w] = (best[1], ids[best[1]], best[0] == 0)
    for made in (index, None):
        assert {r.term: (r.ontology_label, r.ontology_id, r.exact_match) for r in mapping.exact_then_fuzzy(terms, onto, most, made).collect()} == want
    near = {(r.term, r.ontology_label): r.edits for r in mapping.near_terms(terms, index, most).collect()}
    every = {(w, x): n for w in words for x in labels if w and (n := edits(w, x)) <= most}
    assert near.items() <= every.items() and all(len(w) <= most and len(x) <= most for w, x in every.keys() - near.keys())


def test_enrich_demote_and_summary(spark):
    m = spark.createDataFrame([(0, "a", "L", "chunk_0"), (1, "b", "L", "chunk_0"), (2, "c", "M", "chunk_1"), (3, "d", "M", None)], "seq int, entity string, label string, chunk string")
    maps = spark.createDataFrame([("a", "GO:1", "A", "go", None, "local"), ("b", "bad iri", "B", "go", None, "local"), ("c", None, None, None, "No mapping found", "remote")], "term string, ontology_id string, ontology_label string, ontology string, error string, mapping_backend string")
    e = mapping.enrich(m, maps)
    assert {(r.seq, r.ontology_uri, r.concept_mapping_provenance, r.mapping_backend) for r in e.collect()} == {(0, "GO:1", "tool", "local"), (1, "bad iri", "tool", "local"), (2, None, "unmapped", "remote"), (3, None, "unmapped", "auto")}
    made_up = e.withColumn("concept_mapping_provenance", F.when(F.col("seq") == 0, "LLM_knowledge").otherwise(F.col("concept_mapping_provenance")))
    d = {r.seq: r for r in mapping.demote(made_up).collect()}
    assert (d[0].ontology_validation, d[0].ontology_validation_error, d[0].ontology_uri, d[0].mapping_error) == ("invalid_demoted", "llm_knowledge_rejected", None, "llm_knowledge_rejected")
    assert (d[1].ontology_validation, d[1].alignment_method, d[1].concept_mapping_provenance) == ("invalid_demoted", "validation_failed", "unmapped")
    assert (d[2].ontology_validation, d[2].mapping_error) == ("not_mapped", "No mapping found")
    assert {r.ontology_validation for r in mapping.demote(e, strict=False).collect()} == {"valid", "not_mapped"}
    again = mapping.demote(made_up.withColumn("mapping_error", F.lit("was llm_knowledge_rejected")))
    assert {r.seq: r.mapping_error for r in again.collect()}[0] == "was llm_knowledge_rejected"
    s = mapping.validation_summary(mapping.demote(made_up)).first()
    assert (s.valid_mapped, s.unmapped, s.invalid_demoted, s.invalid_by_reason) == (0, 4, 2, {"llm_knowledge_rejected": 1, "malformed_iri": 1})
    assert [(x.extracted_text, x.ontology_uri) for x in s.invalid_examples] == [("a", "GO:1"), ("b", "bad iri")]


RAW = [
    # seq, entity, extracted_text, label, llm_label, context, sentence, chunk, source_pass, ontology_id, ontology_uri, provenance, judge
    (0, "Cortex", None, "R", None, "one", None, "c1", "p1", None, "GO:1", None, 2.0),
    (1, "cortex ", None, "R", None, None, "two", "c0", "p1", "GO:2", None, "unmapped", None),
    (2, "", "cortex", "", "R", "one", None, "c1", "p2", None, None, None, 5.5),
    (3, None, None, "R", None, None, None, None, None, None, None, None, None),
    (4, "x\ny", None, None, None, None, None, None, None, "bad id", None, None, None),
    (5, "z", None, "", None, None, None, "", None, None, None, "tool", None),
]
SCHEMA = "seq int, entity string, extracted_text string, label string, llm_label string, context string, sentence string, chunk string, source_pass string, ontology_id string, ontology_uri string, concept_mapping_provenance string, judge_score double"


def test_audit_normal_form(spark):
    n = {r.seq: r for r in audit.normalize(spark.createDataFrame(RAW, SCHEMA), audit.ENTITIES).collect()}
    assert [(s, n[s].id, n[s].entity, n[s].label) for s in sorted(n)] == [(0, "mention_000000", "Cortex", "R"), (1, "mention_000001", "cortex", "R"), (2, "mention_000002", "cortex", "R"), (4, "mention_000003", "x y", None), (5, "mention_000004", "z", None)]
    assert [(n[s].ontology_id, n[s].concept_mapping_provenance, n[s].alignment_method) for s in (0, 1, 2, 4)] == [("GO:1", "tool", "direct_tool_call"), ("GO:2", "unmapped", "direct_tool_call"), (None, "skipped", "skipped"), ("bad id", "tool", "direct_tool_call")]
    assert n[1].sentence == n[1].context == "two" and n[0].source_fields == {"judge_score": "2.0"} and not n[1].source_fields
    mapped = {r.seq: r for r in audit.normalize(spark.createDataFrame(RAW, SCHEMA), audit.MAPPED).collect()}
    assert (mapped[2].concept_mapping_provenance, mapped[2].alignment_method) == ("unmapped", "direct_tool_call")
    assert [audit.input_kind(c) for c in (["master_entities", "backend"], ["entities", "backend"], ["entities"])] == [audit.MASTER, audit.MAPPED, audit.ENTITIES]
    with pytest.raises(ValueError):
        audit.input_kind(["x"])


def test_audit_validation_groups_and_counts(spark):
    n = audit.normalize(spark.createDataFrame(RAW, SCHEMA), audit.ENTITIES)
    v = audit.validate_ontology(n)
    assert {r.seq: (r.ontology_validation, r.ontology_validation_error) for r in v.collect()} == {0: ("valid", None), 1: ("valid", None), 2: ("not_mapped", None), 4: ("invalid", "malformed_iri"), 5: ("invalid", "missing_ontology_id")}
    assert tuple(audit.ontology_counts(v).first()) == (2, 2, 0, 1)
    g = {(r.entity, r.label): r for r in audit.groups(n, with_ids=True).collect()}
    c = g["cortex", "R"]
    assert (c.mention_count, c.mention_ids, c.chunks, c.source_passes, c.contexts) == (3, ["mention_000000", "mention_000001", "mention_000002"], ["c0", "c1"], {"p1": 2, "p2": 1}, ["one", "two"])
    assert (c.ontology_id, c.judge_score_max, c.judge_score_avg, c.judge_score_min) == ("GO:1", 5.5, 3.75, 2.0)
    assert [r.mention_count for r in audit.groups(n).collect()] == [3, 1, 1]
    counted = {(r.counter, r.value): r.n for r in audit.counters(n).collect()}
    assert counted["label", "R"] == 3 and counted["label", "Unknown"] == 2 and counted["chunk", "unknown"] == 2 and counted["mapping_backend", "none"] == 5
    assert tuple(audit.totals(n).first()) == (5, 3, 3, 3, 2, 1.67)
    assert tuple(audit.totals(n.limit(0)).first())[:5] == (0, 0, 0, 0, 0)


def test_span_validation_is_three_valued(spark):
    m = spark.createDataFrame([(0, "bc", 1, 3, None, None, "k"), (1, "bc", 0, 2, 5, 7, "k"), (2, "bc", 0, 2, None, None, "k"), (3, "bc", None, None, 5, 7, "none"), (4, "q", None, None, None, None, "k"), (5, "a", 0, 99, None, None, "k")], "seq int, entity string, start int, end int, global_start int, global_end int, chunk string")
    chunks = spark.createDataFrame([("k", "abcd")], "chunk string, body string")
    src = m.select("seq").withColumn("body", F.when(F.col("seq") == 3, "").otherwise("01234bc"))
    got = {r.seq: r.span_validation for r in audit.validate_spans(m, chunks, src, ["chunk"], ["seq"]).collect()}
    assert got == {0: "valid", 1: "valid", 2: "invalid", 3: "not_checked", 4: "not_checked", 5: "invalid"}


def test_payloads(spark):
    ok = {"entity": "e", "label": "l", "context": "c" * 1200, "extra": [1]}
    rows = [json.dumps([ok]), "[]", json.dumps(ok), "nope", json.dumps([ok, 5]), json.dumps([{"entity": "e", "label": "l"}]), json.dumps([{**ok, "label": "  "}])]
    out = audit.validate_payload(spark.createDataFrame(list(enumerate(rows)), "i int, payload string")).orderBy("i").collect()
    assert [r.error is None for r in out] == [True, True, False, False, False, False, False]
    assert out[0].entities[0].context == "c" * 1000 + "…" and out[1].entities == []
    assert "label" in out[6].error and "context" in out[5].error and "1" in out[4].error


def test_tagger(spark):
    docs = spark.createDataFrame([(0, "Aa bb Cc " * 100), (1, ""), (2, None), (3, "Zz")], "doc_id int, text string")
    tag = tagger.PatternTagger({"UP": (r"[A-Z]\w", 0.9), "LOW": (r"\b[a-z]\w", 0.2)})
    raw = tagger.tag(docs, tag, ["UP", "LOW"], 0.5, 20, 5)
    whole = tagger.tag(docs, tag, ["UP"], 0.5, 0)
    assert raw.count() > whole.count() == 201
    assert {(r.doc_id, r.start, r.end, r.entity) for r in tagger.dedupe(raw).collect()} == {(r.doc_id, r.start, r.end, r.entity) for r in whole.collect()}
    gaz = tagger.GazetteerTagger({"C": ["Cc", "Zz"]})
    assert tagger.tag(docs, gaz, ["C"]).where("doc_id = 3").count() == 1
    scored = spark.createDataFrame([(0, 1, 2, "L", None, 0), (0, 1, 2, "L", 0.5, 1), (0, 1, 2, "L", 0.5, 2)], "doc_id int, start int, end int, label string, score double, seq int")
    assert [r.seq for r in tagger.dedupe(scored).collect()] == [1]
    odd = spark.createDataFrame([("abcd", 1, 3, None, "T", 0.4), ("abcd", -1, 2, "given", "T", None)], "text string, start_pos int, end_pos int, entity string, entity_type string, score double")
    got = sorted((r.entity, r.label, r.start, r.end, r.context) for r in tagger.normalize(odd).collect())
    assert got == [("bc", "T", 1, 3, "abcd"), ("given", "T", -1, 2, "")]


def test_model_calls(spark):
    df = spark.createDataFrame([(0, "x"), (1, None), (2, "bad")], "id int, decorated string")
    out = {r.id: r.refined for r in llm_calls.refine(df, lambda t: f"```md\n[{t}](L)\n```").collect()}
    assert out == {0: "[x](L)", 1: None, 2: "[bad](L)"}

    def fails(t):
        if t == "bad":
            raise llm_calls.Retryable("later")
        return t

    tries = {r.id: r.y_error for r in llm_calls.call_column(df, "decorated", "y", llm_calls.retrying(fails, 2, 0.0), on_error="null").collect()}
    assert tries == {0: None, 1: None, 2: "Retryable: later"}
    with pytest.raises(Exception):
        llm_calls.call_column(df, "decorated", "y", fails).collect()
    masked = df.withColumnRenamed("decorated", "masked_text")
    reply = lambda t: 'ok {"entities": [{"entity": " a  b ", "label": "X Y"}]}'
    assert {r.id: r.found for r in llm_calls.discover(masked, reply).collect()}[0][0].asDict() == {"entity": "a b", "label": "X_Y"}
    assert {r.id: r.found for r in llm_calls.discover(masked).collect()}[0] == []
    for bad in ("no json", '{"entities": [{"entity": "a*", "label": "L"}]}'):
        with pytest.raises(Exception, match="invalid reply"):
            llm_calls.discover(masked, lambda t, bad=bad: bad).collect()
