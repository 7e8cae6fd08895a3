"""The training-data queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import codes, decontaminate, exact, fingerprints, licenses, lines, middle, pieces, quality, simhash, suffixes, toxicity, warc
from .common import table
from .words import words


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical exact fingerprint of every document and of its edited text."""
    return fingerprints.edit_report(table(spark, sf_dir, "documents"))


def op2_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record into ZIP archives and read back from them."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base license phrases of every document, and the labels of the license templates that its blocks contain."""
    return licenses.verdict(licenses.scan(table(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fold, and its passages' number and words."""
    found = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    inside = F.aggregate("passages", F.lit(0).cast("long"), lambda a, p: a + p["end"] - p["start"])
    return found.select("doc_id", "held_out", "score", "predicted", F.size("passages").cast("long").alias("n_passages"), inside.alias("passage_words"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, how many of them repeat a line elsewhere, and the text that is left."""
    found = lines.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document (their number and digest), what they decode to, and parity with sentencepiece."""
    return pieces.round_trip(table(spark, sf_dir, "documents"), pieces.load())


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in 13-word windows of benchmark items, and which items those are."""
    found = decontaminate.verdict(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), "contaminated")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels outside the held-out fold."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the bytes of 200-byte strings that also start elsewhere."""
    return suffixes.report(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fill-in-middle form, the digest of its output, and of the text rebuilt from it."""
    return middle.report(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code and error of every usable vector, and the digest of the codebooks."""
    return codes.report(table(spark, sf_dir, "embeddings"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the documents with equal texts stays, and how many there are, for every document."""
    return exact.report(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


_TEMPLATES = ", ".join(f"({n}, '{label}', '{text}', {own.split()}, {licenses.room(len(words(text.encode())))})" for n, (label, text, own) in enumerate(licenses.TEMPLATES))
_PHRASES = ", ".join(f"({[*phrase.split()]}, '{label}')" for phrase, label in licenses.PHRASES.items())
_HALF = licenses.BLOCK // 2

OP3_SQL = f"""
WITH t AS (SELECT n, label, own, room, list_distinct({_sql_words("text")}) AS t FROM (VALUES {_TEMPLATES}) AS v(n, label, text, own, room)),
p AS (SELECT * FROM (VALUES {_PHRASES}) AS v(phrase, label)),
d AS (SELECT doc_id, {_sql_words("text")} AS w FROM documents),
places AS (SELECT doc_id, i, label FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM d) x, p WHERE list_slice(w, i + 1, i + len(phrase)) = phrase),
base AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY doc_id),
blocks AS (SELECT doc_id, s, list_slice(w, s + 1, s + {licenses.BLOCK}) AS b FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - {_HALF}, 1), {_HALF})) AS s FROM d WHERE len(w) > 0)),
near AS (SELECT doc_id, s, b, n, label, t, own, room FROM blocks, t WHERE len(list_intersect(t, b)) >= {licenses.THRESHOLD} * len(t) - 1e-9 AND list_has_all(b, own)),
spread AS (SELECT doc_id, s, n, label, len(t) AS size, i, list_intersect(t, list_slice(b, i + 1, i + room)) AS m, own FROM (SELECT *, unnest(range(0, greatest(len(b) - room + 1, 1))) AS i FROM near)),
shared AS (SELECT doc_id, s, n, label, size, arg_min(m, i - 1000 * len(m)) AS m FROM spread WHERE len(m) >= {licenses.THRESHOLD} * size - 1e-9 AND list_has_all(m, own) GROUP BY doc_id, s, n, label, size),
met AS (SELECT doc_id, label, len(m) / size AS share FROM shared x WHERE NOT EXISTS (SELECT 1 FROM shared y WHERE y.doc_id = x.doc_id AND y.s = x.s AND len(y.m) > len(x.m) AND list_has_all(y.m, x.m))),
best AS (SELECT doc_id, max(share) AS share FROM met GROUP BY doc_id),
every AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM met UNION ALL SELECT doc_id, label FROM places) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.lo AS first_word, b.hi AS last_word, coalesce(b.labels, '') AS base_labels,
  coalesce(e.labels, '') AS labels, CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best.share, 0)::DOUBLE END AS score
FROM d LEFT JOIN base b USING (doc_id) LEFT JOIN every e USING (doc_id) LEFT JOIN best USING (doc_id)
"""

OP8_SQL = f"""
WITH d AS (SELECT doc_id, {_sql_words("text")} AS w FROM documents),
b AS (SELECT item_id, {_sql_words("text")} AS w FROM benchmark),
wins AS (SELECT item_id, list_slice(w, i, i + 12) AS win FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM wins),
grams AS (SELECT doc_id, n, s, list_slice(w, s, s + n - 1) AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT g.doc_id, g.s, g.n, k.item_id FROM grams g JOIN wins k ON g.win = k.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM found)) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit h USING (doc_id) LEFT JOIN ids i USING (doc_id)
"""

OP11_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, w, len(w)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT doc_id, t, w, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
x AS (SELECT doc_id, t, n, form, array_to_string(list_slice(w, 1, a), '') AS p, array_to_string(list_slice(w, a + 1, b), '') AS m, array_to_string(list_slice(w, b + 1, n), '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM x
"""

OP13_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[ 	-
]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


def _op12_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds written out: assignment a0, codebook b1, assignment a1 and so on."""
    steps = [
        f"v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS e, len(embedding) // {parts} AS w FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"x AS MATERIALIZED (SELECT vec_id, label, p, list_slice(e, p * w + 1, p * w + w) AS c FROM v, range({parts}) r(p))",
        f"b0 AS MATERIALIZED (SELECT p, rank() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, c FROM x WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {entries}))",
    ]
    dist = "list_sum(list_transform(list_zip(x.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, label, p, c, n.k, n.d FROM (SELECT x.vec_id, x.label, x.p, x.c, min({{'d': {dist}, 'k': b.k}}) AS n FROM x JOIN b{r} b ON x.p = b.p GROUP BY ALL))")
        if r < rounds:
            steps.append(f"m{r} AS MATERIALIZED (SELECT p, k, list(m ORDER BY i) AS c FROM (SELECT p, k, i, floor(sum(y) / count(*))::BIGINT AS m FROM (SELECT p, k, unnest(c) AS y, unnest(range(len(c))) AS i FROM a{r}) GROUP BY p, k, i) GROUP BY p, k)")
            steps.append(f"b{r + 1} AS MATERIALIZED (SELECT p, k, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN m{r} m USING (p, k))")
    steps.append(f"g AS (SELECT vec_id, label, string_agg(printf('%02x', k), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY ALL)")
    steps.append(f"h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM b{rounds})")
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM g, h"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op7_sentencepiece": op7_sentencepiece,
        "op10_suffix_array_dedup": op10_suffix_array_dedup,
        "op8_benchmark_decontamination": op8_benchmark_decontamination,
        "op9_quality_classifier": op9_quality_classifier,
        "op1_document_fingerprints": op1_document_fingerprints,
        "op2_warc_archives": op2_warc_archives,
        "op3_license_scan": op3_license_scan,
        "op4_toxicity": op4_toxicity,
        "op5_line_dedup": op5_line_dedup,
        "op6_simhash_near_dedup": op6_simhash_near_dedup,
        "op11_fill_in_middle": op11_fill_in_middle,
        "op12_vector_codes": op12_vector_codes,
        "op13_exact_dedup": op13_exact_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_license_scan": OP3_SQL, "op8_benchmark_decontamination": OP8_SQL, "op11_fill_in_middle": OP11_SQL, "op12_vector_codes": _op12_sql(), "op13_exact_dedup": OP13_SQL}
