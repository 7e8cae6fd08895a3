"""Tokens of a byte-pair vocabulary counted by words."""

import pathlib
import random

import pytest

from spanlake.functions import tokenizers as V
from spanlake.operators import segment as S

FILE = pathlib.Path("/opt/tokenizers/byte_bpe_50k.json")
ODD = "a b\n\n  c \x1c x y\xa0 'll 's don't 12 345\t\tz 　 é漢字  q <|endoftext|> end. "


@pytest.fixture
def counter():
    if not FILE.is_file():
        pytest.skip("no vocabulary here")
    return V.VocabularyTokens(str(FILE))


def test_words_add_up_to_the_tokens_of_any_piece(counter):
    rng = random.Random(5)
    for text in (ODD * 3, "x" * 300 + " 's\x85 \n\n\n" + "ab " * 50, " ", "\n a"):
        count = counter.counter(text)
        for _ in range(300):
            a, b = rng.randrange(len(text) + 1), rng.randrange(len(text) + 20)
            assert count(a, b) == len(counter(text[a:b])), (a, b)


def test_packing_tokenises_a_word_once(counter, monkeypatch):
    text = (ODD + "Some more words of a text that goes on and on, without an end. ") * 40
    want = S.chunks(text, lambda x: counter(x), 100)
    seen, real = [], V._load(counter.path)

    class Counting:
        def encode(self, x, **how):
            seen.append(len(x))
            return real.encode(x, **how)

    monkeypatch.setattr(V, "_load", lambda path: Counting())
    V._kept.cache_clear()
    assert S.chunks(text, counter, 100) == want and sum(seen) < len(text) / 4
    assert V.VocabularyTokens("/opt/tokenizers/word_bpe_49k.json").counter(text) is None  # normalises: not by words
