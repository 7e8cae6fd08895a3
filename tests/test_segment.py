import pathlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanlake.functions.tokenizers import VocabularyTokens, model_limit
from spanlake.operators import segment as S

TEXT = st.text(alphabet="aB. !?\n\")'1,;#-é", max_size=120)


def paragraph_spec(text):
    """From a non-space on, through the first character that is followed by an empty line or the end and is no space; a single character takes more if it can."""
    out, at = [], 0
    while at < len(text):
        if text[at].isspace():
            at += 1
            continue
        ends = [e for e in range(at + 1, len(text) + 1) if not text[e - 1].isspace() and (e == len(text) or re.match(r"\n\s*\n", text[e:]))]
        longer = [e for e in ends if e > at + 1]
        if not ends:
            at += 1
            continue
        end = (longer or ends)[0]
        out.append((at, end))
        at = end
    return out


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_paragraphs(text):
    text = text.strip()
    assert S.paragraphs(text) == paragraph_spec(text)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_sentences_cover_the_text(text):
    spans = S.sentences(text)
    assert all(text[a:b] == text[a:b].strip() != "" for a, b in spans)
    assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
    assert re.sub(r"\s", "", "".join(text[a:b] for a, b in spans)) == re.sub(r"\s", "", text)


def test_sentence_boundaries(spark):
    cases = {
        'He said "no." Then left.': ['He said "no."', "Then left."],
        "e.g. lower case": ["e.g. lower case"],
        "A.\nB\n\n- item": ["A.", "B", "- item"],
        "One! 2 two? #x": ["One!", "2 two?", "#x"],
        "": [],
    }
    for text, want in cases.items():
        assert [text[a:b] for a, b in S.sentences(text)] == want
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = [r[0] for r in df.select(S.sentence_array(F.col("t"))).collect()]
    assert got == list(cases.values())


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 6))
def test_chunks_stay_in_budget_and_miss_nothing(text, most):
    text = text.strip()
    units = S.units(text, S.whitespace_tokens, most)
    out = S.chunks(text, S.whitespace_tokens, most)
    assert all(len(text[a:b].split()) <= most for a, b in units)
    assert all(n == len(text[a:b].split()) <= most for a, b, n, _ in out)
    covered = {i for a, b, _, _ in out for i in range(a, b)}
    assert all(i in covered for a, b in units for i in range(a, b))
    for (a, b, *_), (c, d, *_) in zip(out, out[1:]):
        assert a < c and b < d


def test_one_sentence_overlap_where_it_fits():
    text = "A b c. D e. F g h i. J."
    assert [text[a:b] for a, b, *_ in S.chunks(text, S.whitespace_tokens, 6)] == ["A b c. D e.", "D e. F g h i.", "F g h i. J."]
    # no room for the sentence before beside the next one
    assert [text[a:b] for a, b, *_ in S.chunks(text, S.whitespace_tokens, 5)] == ["A b c. D e.", "F g h i. J."]


def test_oversized_sentences():
    t = "aa bb, cc dd ee; " + "ff " * 5 + "gg, hh"
    out = S.split_oversized(t, 0, len(t), S.whitespace_tokens, 4)
    assert [t[a:b] for a, b in out] == ["aa bb,", "cc dd ee;", "ff ff ff ff", "ff gg,", "hh"]
    chars = lambda x: [(i, i + 1) for i, c in enumerate(x) if not c.isspace()]
    assert [("x" * 10)[a:b] for a, b in S.split_oversized("x" * 10, 0, 10, chars, 4)] == ["xxxx", "xxxx", "xx"]


def test_token_limit():
    assert (S.token_limit(64), S.token_limit(None), S.token_limit(None, 512), S.token_limit(None, 10), S.token_limit(None, 10**9)) == (64, 4096, 435, 32, 4096)
    with pytest.raises(ValueError):
        S.token_limit(5)


@settings(max_examples=150, deadline=None)
@given(TEXT, st.integers(2, 30), st.integers(1, 29))
def test_sliding(text, most, stride):
    if stride >= most:
        with pytest.raises(ValueError):
            S.sliding(text, most, stride)
        return
    out = S.sliding(text, most, stride)
    assert all(0 <= a and b - a <= most for a, b in out)
    assert (not text and not out) or (out[0][0] == 0 and out[-1][1] == len(text))
    assert all(a < c for (a, _), (c, _) in zip(out, out[1:]))


def test_sliding_snaps_back():
    text = "Aaaa bbbb. Cccc dddd. Eeee ffff."
    assert S.sliding(text, 14, 10, 12) == [(0, 11), (10, 22), (20, 32)]
    # a sentence end just before the snap width is not seen
    assert S.sliding(text, 14, 10)[0] == (0, 14)


def test_packing_paragraphs_and_its_legacy():
    paras = ["a" * 4, "b" * 4, "c" * 4, "d" * 30, "e"]
    out = S.packed_paragraphs(paras, 12)
    assert [(at, len(x), kind) for at, x, kind in out[:2]] == [(0, 10, "structural"), (12, 4, "structural")]
    assert {k for *_, k in out} == {"structural", "sliding_window"}
    with pytest.raises(ValueError):
        S.packed_paragraphs(paras, 12, legacy=True)
    # after a full chunk the legacy count is a separator too high
    small = ["a" * 6, "b" * 6, "c" * 3]
    assert [len(x) for _, x, _ in S.packed_paragraphs(small, 11)] == [6, 11]
    assert [len(x) for _, x, _ in S.packed_paragraphs(small, 11, legacy=True)] == [6, 6, 3]


def test_tables(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["", "  "]) + " ".join(rng.choices(["Ab", "c.", "D", "😀", "e,"], k=rng.randint(0, 60))), "x") for i in range(30)] + [(90, None, "x"), (91, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string")
    text = {i: t or "" for i, t, _ in rows}
    for r in S.chunk_table(df, 9).collect():
        assert text[r.doc_id][r.char_start : r.char_end] == r.body and r.token_count <= 9
    for r in S.sentence_table(df).collect():
        assert text[r.doc_id][r.start : r.end] == r.body
    wins = S.window_table(df, 10, 3).collect()
    assert {r.doc_id for r in wins} == set(text)
    for r in wins:
        assert text[r.doc_id][r.start : r.end] == r.body and len(r.body.split()) <= 10
    over = S.with_overlap(S.chunk_table(df, 9)).collect()
    by = {(r.doc_id, r.chunk_index): r for r in over}
    for (d, i), r in by.items():
        want = max(0, by[d, i - 1].char_end - r.char_start) if i else 0
        assert r.overlap_chars_with_previous == want and r.overlap_with_previous == (want > 0)
    assert S.select_chunks(S.chunk_table(df, 9), [0]).where("chunk_index != 0").count() == 0


def test_windows_look_back_no_further_than_the_snap_width():
    class Runs(list):
        seen = 0

        def __getitem__(self, i):
            Runs.seen += 1
            return list.__getitem__(self, i)

    steps = []
    for n in (1000, 2000, 4000):
        stops = S._Stops("word " * 79 * n)
        stops.runs, Runs.seen = Runs(stops.runs), 0
        for cut in range(400, len(stops.text), 400):
            stops.last(cut - 100, cut)
        steps.append(Runs.seen / n)
    assert max(steps) < 1.3 * min(steps)  # by bisection and a walk within the width, whatever the text's size


VOCABULARIES = [p for n in ("byte_bpe_50k.json", "word_bpe_49k.json") if (p := pathlib.Path("/opt/tokenizers") / n).is_file()]


def mixed_text(rng, n):
    words = ["Alpha", "beta,", "gamma.", "New", "line\n", "漢字", "naïve", "😀", "x1-y2", "(see", "note)", "internationalisation", "  ", "...", "a", "I", "3.14", "<|endoftext|>", "don't", "\n\n", "Ünï"]
    return "".join(w + rng.choice([" ", " ", " ", "", "\t"]) for w in rng.choices(words, k=n)).strip()


@pytest.mark.skipif(not VOCABULARIES, reason="no vocabularies here")
@pytest.mark.parametrize("path", VOCABULARIES, ids=lambda p: p.name)
def test_counts_are_those_of_tokenising_anew(path):
    tokens, rng = VocabularyTokens(str(path)), random.Random(4)
    for _ in range(25):
        text = mixed_text(rng, 400)
        count = S._Patched(text, tokens)
        cuts = sorted(rng.sample(range(len(text) + 1), 40))  # anywhere, within words and tokens
        for a in cuts[::3]:
            for b in cuts:
                if a < b:
                    assert count(a, b) == len(tokens(text[a:b])), (text[a:b],)


@pytest.mark.skipif(not VOCABULARIES, reason="no vocabularies here")
@pytest.mark.parametrize("path", VOCABULARIES, ids=lambda p: p.name)
def test_chunks_with_a_vocabulary(path, monkeypatch):
    tokens, rng = VocabularyTokens(str(path)), random.Random(5)
    cases = [(mixed_text(rng, rng.randint(0, 600)), rng.choice([32, 60, 200])) for _ in range(40)] + [("word" * 2000, 32), ("", 32)]
    got = [(S.units(t, tokens, m), S.chunks(t, tokens, m)) for t, m in cases]
    monkeypatch.setattr(S, "_counter", lambda text, tokens, anywhere=False: lambda a, b: len(tokens(text[a:b])))
    assert got == [(S.units(t, tokens, m), S.chunks(t, tokens, m)) for t, m in cases]
    for (t, m), (_, parts) in zip(cases, got):
        assert all(n == len(tokens(t[a:b])) for a, b, n, _ in parts)
        assert all(n <= m for _, _, n, k in parts if k > 1)  # a piece cut within a word may count a token more by itself


def test_work_of_packing_doubles_with_the_text():
    seen = [0]

    def tokens(text):
        seen[0] += len(text)
        return [m.span() for m in re.finditer(r"\s?\w{1,4}|[^\w\s]", text)]

    for budget in (64, 4096):
        steps = []
        for n in (300, 600, 1200):
            text = " ".join(f"Sentence number {i} has some further words in it." for i in range(n))
            seen[0] = 0
            S.chunks(text, tokens, budget)
            steps.append(seen[0] / len(text))
        assert max(steps) < 1.2 * min(steps) < 20  # a few passes over the text, whatever its size and the budget


def test_limits_of_models(tmp_path):
    assert model_limit(str(tmp_path)) is None
    (tmp_path / "tokenizer.json").write_text('{"truncation": {"max_length": 77}}')
    assert model_limit(str(tmp_path)) == 77
    (tmp_path / "tokenizer_config.json").write_text('{"model_max_length": 512}')
    assert model_limit(str(tmp_path)) == 512 and S.token_limit(None, model_limit(str(tmp_path))) == 435
    (tmp_path / "tokenizer_config.json").write_text('{"model_max_length": 1e30}')
    assert model_limit(str(tmp_path)) == 77
