import io
import os
import random

import pytest

from spanlake.llm import pieces as P

pytestmark = pytest.mark.skipif(not os.path.exists(P.MODEL_PATH), reason="no vocabulary installed")

EDGES = ["", " ", "  a  b ", "a", "\n", "a\n b", "<s> </s> <unk>", "▁x", "x▁▁y ▁", "😀é\x00\x01", "\t tab", "日本語 の", "aaaaaaa aaaa", "<0x41>", "ﬁ①", "a" * 3000, "   ", " lead", "trail ", "a " * 50000]


def texts():
    rng = random.Random(1)
    parts = ["the", "Straße", "école,", "x1", "\n", "", " ", "naïve.\n", "▁", "🙂", "0.5", "def f(x):", " ", "مرحبا"]
    return EDGES + [" ".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(150)]


def test_parity_with_sentencepiece_and_library():
    codec, t = P.load(), texts()
    flat, off, agree, back = codec.both_ways(t)
    mine = [flat[a:b].tolist() for a, b in zip(off, off[1:])]
    assert mine == codec.expected(t) == codec.library_encode(t) and agree.all()
    assert back == [codec.ref.decode(x) for x in mine] == codec.library_decode(mine)
    assert back == [x.replace("▁", " ") for x in t]


def test_parse_against_library():
    import sentencepiece

    data = open(P.MODEL_PATH, "rb").read()
    spec, sp = P.parse(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    assert [(t, s) for t, s, _ in spec.pieces] == [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.vocab_size())]
    with pytest.raises((ValueError, IndexError)):
        list(P.fields(data[: len(data) // 2]))


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def test_unigram_with_byte_fallback(tmp_path):
    """A hand-written unigram model: pieces with scores, and bytes for what no piece covers."""
    import struct

    pieces = [("<unk>", 0.0, P.UNKNOWN), ("<s>", 0.0, P.CONTROL), ("</s>", 0.0, P.CONTROL)]
    pieces += [(f"<0x{b:02X}>", 0.0, P.BYTE) for b in range(256)]
    pieces += [(t, s, P.NORMAL) for t, s in [("▁", -2.0), ("▁th", -3.1), ("e", -2.2), ("▁the", -3.7), ("t", -2.9), ("h", -3.0), ("he", -2.6), ("▁a", -2.5), ("at", -2.4), ("c", -3.3), ("▁c", -3.2), ("cat", -4.1)]]
    out = io.BytesIO()
    for text, score, kind in pieces:
        body = b"\x0a" + varint(len(text.encode())) + text.encode() + b"\x15" + struct.pack("<f", score) + b"\x18" + varint(kind)
        out.write(b"\x0a" + varint(len(body)) + body)
    trainer = b"\x18\x01" + varint(35 << 3) + b"\x01"
    norm = b"\x0a\x08identity" + b"\x18\x01\x20\x00\x28\x01"
    out.write(b"\x12" + varint(len(trainer)) + trainer + b"\x1a" + varint(len(norm)) + norm)
    codec = P.Codec(out.getvalue())
    t = ["the cat", "a the", "that cat hat", "é x", "", "cat  at"]
    assert P.parse(out.getvalue()).model_type == P.UNIGRAM
    assert codec.library_encode(t) == codec.expected(t)
    flat, off, agree, back = codec.both_ways(t)
    assert [flat[a:b].tolist() for a, b in zip(off, off[1:])] == codec.expected(t)
    assert back == t and agree.all()


class Broken(P.Codec):
    """A backend whose ids, or texts, are wrong wherever an x is."""

    side = "encode"

    def library_encode(self, texts):
        return [[*x[:-1], 7] if self.side == "encode" and "x" in t else x for x, t in zip(super().library_encode(texts), texts)]

    def library_decode(self, ids):
        return [t.replace("x", "y") if self.side == "decode" else t for t in super().library_decode(ids)]


def test_results_are_those_of_the_library():
    """A library that goes wrong shows in ids, texts and parity; sentencepiece stands in for nothing."""
    codec = Broken(open(P.MODEL_PATH, "rb").read())
    flat, off, agree, _ = codec.both_ways(["plain words", "x", "words"])
    assert agree.tolist() == [True, False, True] and flat[off[1] : off[2]].tolist()[-1] == 7
    codec = Broken(open(P.MODEL_PATH, "rb").read())
    codec.side = "decode"
    *_, agree, back = codec.both_ways(["plain words", "x ray", "words"])
    assert agree.tolist() == [True, False, True] and back == ["plain words", "y ray", "words"]


def test_long_texts_and_words():
    codec = P.load()
    t = ["word " * 200_000, "ab" * 100_000, "é" * 50_000 + " end", "1234567890" * 5_000]
    flat, off, agree, back = codec.both_ways(t)
    assert agree.all() and back == t and [flat[a:b].tolist() for a, b in zip(off, off[1:])] == codec.library_encode(t)


def test_operators(spark):
    t = texts()
    rows = [(i, x, "keep") for i, x in enumerate(t)] + [(None, "null id", "k"), (3, None, None), (5, "twice", "k"), (5, "twice", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    codec = P.load()
    got = P.encode(df, codec).collect()
    assert all(r.parity for r in got)
    want = codec.expected([x or "" for _, x, _ in rows])
    assert sorted((str(r.doc_id), r.text or "", list(r.ids)) for r in got) == sorted((str(i), x or "", w) for (i, x, _), w in zip(rows, want))
    back = P.decode(P.encode(df, codec), codec).collect()
    assert sorted(r.text for r in back) == sorted((x or "").replace("▁", " ") for _, x, _ in rows)
    report = P.round_trip(df, codec).collect()
    assert len(report) == len(rows) and all(r.round_trip and r.parity for r in report)
    assert P.round_trip(df.limit(0), codec).count() == 0
