import json

import pytest
from pyspark.sql import functions as F

from spanlake.functions import iri
from spanlake.functions import text as tx


def values(spark, rows, f, kind="string"):
    df = spark.createDataFrame(list(enumerate(rows)), f"i int, c {kind}")
    return [r.v for r in df.select("i", f(F.col("c")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "f, given, want",
    [
        (tx.strip, ["  a\n", "", None, " \t"], ["a", "", None, ""]),
        (tx.normalize_text, ["a­ b \t , c\n.", "x\u000by"], ["a b, c.", "x y"]),
        (tx.normalize_markdown, ["a\n\n\n\nb  c ", "\n\na\n\nb"], ["a\n\nb c", "a\n\nb"]),
        (tx.collapse_blanks, [" a \t b ", "  ", None], ["a b", None, None]),
        (tx.clean_text, [None, " a\r\nb\rc\n\td "], ["", "a b c d"]),
        (tx.sanitize_term, ["a​b\u0007c d", "x" * 499 + " y z", None], ["abc d", "x" * 499, ""]),
        (tx.folded, ["Straße  X\n", " É "], ["strasse x", "é"]),
        (tx.clean_label, [" Brain  Region! ", "a-b_c"], ["Brain_Region", "ab_c"]),
        (tx.markup_label, [" a b "], ["a_b"]),
        (tx.entity_text, ["a \n b", "a*b", " "], ["a b", None, ""]),
        (tx.strip_fences, ["```json\n{}\n```", "``` \nx\ny\n  ```\n", "x ``` y", "```\nno end", "``````"], ["{}", "x\ny", "x ``` y", "no end", ""]),
        (tx.lenient_json, ['{"a": 1}', 'ok {"a": 1} bye', "[1]", "see [1, 2].", "none", '{"a": '], ['{"a": 1}', '{"a": 1}', '{"entities": [1]}', '{"entities": [1, 2]}', None, None]),
        (tx.chunk_number, ["chunk_012", "a/chunk_3", "chunk_3.txt", "x", None], [12, 3, None, None, None]),
        (tx.safe_name, ["a/b c.txt", "ü.tar.gz", ".hidden"], ["b_c.json", "_.tar.json", ".hidden.json"]),
        (tx.path_segment_error, ["ok name", "", " ", "a/b", "a..b", "a\tb", None], [None, "empty", "empty", "separator or white space", "separator or white space", "separator or white space", "empty"]),
        (tx.result_count, ["5", "0", "99", "x", None], [5, 1, 20, 1, 1]),
        (tx.parse_labels, ["a, b,a,,", '["x", " x ", ""]', " ", "[]"], [["a", "b"], ["x"], None, None]),
        (tx.term_context, ["", None, "y" * 300], [None, None, "y" * 200]),
        (tx.count_tokens, ["a b c", "", None], [3, 0, None]),
    ],
)
def test_text(spark, f, given, want):
    assert values(spark, given, f) == want


def test_label_set_keeps_first_places_and_thirty(spark):
    given = [["b-c d", "a", "A", "__x  y", "!"], [f"l{i}" for i in range(40)]]
    assert values(spark, given, tx.label_set, "array<string>") == [["BC_D", "A", "_X_Y"], [f"L{i}" for i in range(30)]]


def test_context_counts_code_points(spark):
    text = "😀" * 3 + "x" * 150 + "MID" + "\n y" * 60
    rows = [(text, 153, 156), (text, 0, 1), (text, 5, 5), (text, None, 3), (text, 1, 10**6)]
    df = spark.createDataFrame(rows, "t string, s int, e int")
    got = [r[0] for r in df.select(tx.context(F.col("t"), F.col("s"), F.col("e"))).collect()]
    want = [" ".join(text[53:256].split()), " ".join(text[:101].split()), None, None, None]
    assert got == want


def test_iri(spark):
    given = ["http://purl.obolibrary.org/obo/GO_0001", " UBERON:12 ", "N/A", "", None, "two words", "urn:a:b", "MGI:1", "http://a/b_7", "http://purl.bioontology.org/ontology/SNOMEDCT/9"]
    assert values(spark, given, iri.well_formed) == [True, True, False, False, False, False, True, True, True, True]
    assert values(spark, given, iri.known_ontology) == ["go", "uberon", None, None, None, None, None, "mgi", None, "snomedct"]
    assert values(spark, given, iri.plausible) == [True, False, False, False, False, False, False, False, True, True]
    assert len(iri.registry()) == 22


def test_lenient_json_reads_back(spark):
    entities = {"entities": [{"entity": "a", "label": "B"}]}
    for raw in (json.dumps(entities), "Sure:\n" + json.dumps(entities), json.dumps(entities["entities"])):
        assert json.loads(values(spark, [raw], tx.lenient_json)[0]) == entities
