"""SentencePiece encoding and decoding on the tokenizers library.

The model file is parsed as protobuf wire format; normaliser, whitespace marker, scores and byte fallback are rebuilt as
a tokenizers pipeline: a unigram model from its scores, a BPE model from merges in the order of its scores. Batches are
encoded and decoded by the library's own threads, and its results are the results. sentencepiece only judges them: each
row says whether the two agree on all of it.

Where no piece goes on past a word's end, a text's encoding is that of its words one after another. Then each new word
of a task is encoded and decoded once, by the library and by sentencepiece, and texts are put together from what the
library made of their words; a row's parity is that of all its words. Other models take whole texts.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, map_batches

#: Where public vocabularies are installed; the driver reads the file and sends its bytes along.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Kinds of pieces and models in the protobuf.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
UNIGRAM, BPE = 1, 2
#: Text bytes of a batch, and threads that encode it.
BATCH_BYTES, THREADS = 1 << 20, 2
#: Words whose encodings a worker keeps at hand; new words that go in one text of a batch.
WORDS, JOINED = 400_000, 250


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message: varints as int, all else as bytes."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value, at
            shift += 7

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        elif kind == 2:
            size, at = varint(at)
            if at + size > len(data):
                raise ValueError("truncated model")
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield tag >> 3, value


@dataclass
class Spec:
    """What a model file says: pieces as (text, score, kind), and the options that shape encoding."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True
    unk_id: int = 0


def parse(data: bytes) -> Spec:
    spec = Spec()
    for number, value in fields(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for n, v in fields(value):
                if n == 1:
                    text = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            if kind == UNKNOWN:
                spec.unk_id = len(spec.pieces)
            spec.pieces.append((text, score, kind))
        elif number == 2:
            for n, v in fields(value):
                if n == 3:
                    spec.model_type = v
                elif n == 35:
                    spec.byte_fallback = bool(v)
        elif number == 3:
            for n, v in fields(value):
                if n == 2:
                    spec.charsmap = v
                elif n == 3:
                    spec.dummy_prefix = bool(v)
                elif n == 4:
                    spec.trim_spaces = bool(v)
                elif n == 5:
                    spec.escape_spaces = bool(v)
    return spec


def merges(spec: Spec) -> list[tuple[str, str]]:
    """Pairs that the BPE model joins, those of higher-scored results first."""
    ids = {t: i for i, (t, _, kind) in enumerate(spec.pieces) if kind in (NORMAL, USER_DEFINED)}
    out = []
    for text, i in ids.items():
        for k in range(1, len(text)):
            a, b = text[:k], text[k:]
            if a in ids and b in ids:
                out.append((-spec.pieces[i][1], i, ids[a], ids[b], a, b))
    return [(a, b) for *_, a, b in sorted(out)]


def build(spec: Spec):
    """The tokenizers.Tokenizer of a model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if spec.model_type == BPE:
        vocab = {t: i for i, (t, *_) in enumerate(spec.pieces)}
        model = models.BPE(vocab=vocab, merges=merges(spec), unk_token=spec.pieces[spec.unk_id][0], fuse_unk=True, byte_fallback=spec.byte_fallback)
    elif spec.model_type == UNIGRAM:
        model = models.Unigram([(t, s) for t, s, _ in spec.pieces], unk_id=spec.unk_id, byte_fallback=spec.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models")
    tok = Tokenizer(model)
    steps = [normalizers.Precompiled(spec.charsmap)] if spec.charsmap else []
    if spec.trim_spaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    if spec.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    tok.normalizer = normalizers.Sequence(steps)
    if splits_at_words(spec):
        tok.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    tail = [decoders.Strip(" ", 1, 0)] if spec.dummy_prefix else []
    tok.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *tail])
    tok.encode_special_tokens = True
    return tok


def splits_at_words(spec: Spec) -> bool:
    """Whether words can be encoded apart, each with the run of marks before it: no piece has a mark after anything else."""
    return spec.escape_spaces and spec.dummy_prefix and not spec.trim_spaces and not spec.charsmap and not any(MARK in t.lstrip(MARK) for t, _, kind in spec.pieces if kind in (NORMAL, USER_DEFINED))


def word_list(text: str) -> list[str]:
    """A text cut before each run of spaces; the first space of a run stands for the mark that every word begins with."""
    text = text.replace(MARK, " ")
    if "  " not in text and text[:1] != " " and text[-1:] != " ":
        return text.split(" ") if text else []
    out, run = [], 0
    parts = text.split(" ")
    for i, x in enumerate(parts):
        if x or i == len(parts) - 1:
            out.append(" " * run + x)
            run = 0
        else:
            run += 1
    return out


class Codec:
    """Encoder and decoder of a model, with sentencepiece as its judge; built where it is used."""

    def __init__(self, data: bytes, threads: int = THREADS, words: int = WORDS):
        self.data, self.threads, self.words = data, threads, words
        self._clear()
        self._tok = self._ref = None

    def __reduce__(self):
        return _codec, (self.data, self.threads, self.words)

    def _clear(self):
        self._at: dict[str, int] = {}
        self._ids, self._ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self._agree, self._back = np.zeros(0, bool), []

    @property
    def tok(self):
        if self._tok is None:
            os.environ["RAYON_NUM_THREADS"], os.environ["TOKENIZERS_PARALLELISM"] = str(self.threads), "true"
            self.spec = parse(self.data)
            self._tok = build(self.spec)
            self.mark = self._tok.token_to_id(MARK)
            self.marked = np.array([t.startswith(MARK) for t, *_ in self.spec.pieces])
            self.by_word = splits_at_words(self.spec) and self.mark is not None
        return self._tok

    @property
    def ref(self):
        if self._ref is None:
            import sentencepiece

            self._ref = sentencepiece.SentencePieceProcessor(model_proto=self.data)
        return self._ref

    def library_encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def expected(self, texts: list[str]) -> list[list[int]]:
        """What sentencepiece makes of the texts."""
        return self.ref.encode(texts, num_threads=self.threads)

    def _words(self, words: list[str]) -> list[list[int]]:
        """The library's encoding of each word."""
        return self._cut(words, self.library_encode)

    def _cut(self, words: list[str], encode) -> list[list[int]]:
        """What `encode` makes of each word. Those without spaces go many to a text, which is cut apart at the marks they begin with."""
        out: list[list[int]] = [[self.mark] if not w else [] for w in words]  # an empty word is a lone mark at the end
        plain, odd = [i for i, w in enumerate(words) if w and " " not in w], [i for i, w in enumerate(words) if " " in w]
        parts = [plain[at : at + JOINED] for at in range(0, len(plain), JOINED)]
        for some, ids in zip(parts, encode([" ".join(words[i] for i in some) for some in parts]) if parts else []):  # one batch, whose texts the threads share
            begins = np.flatnonzero(self.marked[np.array(ids, np.int64)]).tolist() if ids else []
            if len(begins) != len(some):  # a vocabulary, or a backend, without words' beginnings
                odd += some
                continue
            for i, a, b in zip(some, begins, [*begins[1:], len(ids)]):
                out[i] = ids[a:b]
        for i, ids in zip(odd, encode([words[i] for i in odd]) if odd else []):
            out[i] = ids
        return out

    def _learn(self, new: list[str]) -> None:
        """Add what the library makes of new words, and whether sentencepiece makes the same of them, both ways."""
        mine, theirs = self._words(new), self._cut(new, self.expected)
        back, judged = self.library_decode(mine), self.ref.decode(mine)
        start = len(self._at)
        self._at.update((w, start + i) for i, w in enumerate(new))
        self._ids = np.r_[self._ids, np.fromiter(itertools.chain.from_iterable(mine), np.int32)]
        self._ends = np.r_[self._ends, self._ends[-1] + np.cumsum([len(x) for x in mine], dtype=np.int64)]
        self._agree = np.r_[self._agree, [a == b and x == y for a, b, x, y in zip(mine, theirs, back, judged)]]
        self._back += back

    def _lookup(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all texts, and the offsets of each text's (n + 1)."""
        lists = [word_list(t) for t in texts]
        if len(self._at) > self.words:
            self._clear()
        flat = list(itertools.chain.from_iterable(lists))
        at = np.fromiter(map(self._at.get, flat, itertools.repeat(-1)), np.int64, len(flat))
        unknown = np.flatnonzero(at < 0).tolist()
        if unknown:
            self._learn(list(dict.fromkeys(flat[i] for i in unknown)))
            at[unknown] = [self._at[flat[i]] for i in unknown]
        return at, np.r_[0, np.cumsum([len(x) for x in lists], dtype=np.int64)]

    def _joined(self, at: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        begin, size = self._ends[at], self._ends[at + 1] - self._ends[at]
        total = np.r_[0, np.cumsum(size)]
        ids = self._ids[np.arange(total[-1]) + np.repeat(begin - total[:-1], size)]
        wrong = np.r_[0, np.cumsum(~self._agree[at])]
        return ids, total[words], wrong[words[1:]] == wrong[words[:-1]]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The library's ids of all texts end to end, where each text's begin and end (n + 1 offsets), and whether sentencepiece agrees."""
        self.tok  # noqa: B018
        if self.by_word:
            return self._joined(*self._lookup(texts))
        mine, theirs = self.library_encode(texts), self.expected(texts)
        return np.fromiter((i for x in mine for i in x), np.int32), np.r_[0, np.cumsum([len(x) for x in mine], dtype=np.int64)], np.array([a == b for a, b in zip(mine, theirs)], bool)

    def both_ways(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """encode(), with agreement on decoding as well, and what the library decodes the ids to."""
        self.tok  # noqa: B018
        if self.by_word:
            at, words = self._lookup(texts)
            get, cuts = self._back.__getitem__, words.tolist()
            numbers = at.tolist()
            return *self._joined(at, words), [" ".join(map(get, numbers[a:b])) for a, b in zip(cuts, cuts[1:])]
        ids, off, agree = self.encode(texts)
        lists = [ids[a:b].tolist() for a, b in zip(off, off[1:])]
        back = self.library_decode(lists)
        return ids, off, agree & np.array([x == y for x, y in zip(back, self.ref.decode(lists))], bool), back

    def library_decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of lists of ids; bytes that are no UTF-8 become the replacement character."""
        return self.tok.decode_batch(ids, skip_special_tokens=False) if ids else []


@functools.cache
def _codec(data: bytes, threads: int, words: int) -> Codec:
    """One codec for all tasks of a Python worker, so that they share its words."""
    return Codec(data, threads, words)


def _docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def load(path: str = MODEL_PATH, threads: int = THREADS) -> Codec:
    with open(path, "rb") as f:
        return Codec(f.read(), threads)


def encode(docs: DataFrame, codec: Codec, text_col: str = "text") -> DataFrame:
    """`docs` with the columns ids (array of int) and parity added, in place of any of these names; null and empty texts have no ids.

    ids are the library's; parity is whether sentencepiece makes the same of the row. Rows may repeat, and an empty table
    gives an empty one.
    """
    have = docs.drop("ids", "parity")
    schema = T.StructType([*have.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("parity", T.BooleanType())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, off, agree = codec.encode([x or "" for x in column(batch, text_col).cast(pa.string()).to_pylist()])
        lists = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(flat))
        return pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(agree)], names=[*batch.schema.names, "ids", "parity"])

    return map_batches(have, work, schema, text_col, BATCH_BYTES)


def decode(tokens: DataFrame, codec: Codec, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of each row of ids, as the library decodes them; a null list is an empty one, repeated rows come back as often."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = codec.library_decode([x or [] for x in column(batch, "ids").to_pylist()])
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_batches(tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")), work, "doc_id long, text string")


def round_trip(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip, parity) of each row; other columns of `docs` are not looked at.

    ids_sha256: of the library's ids as little-endian 32-bit integers; decoded_sha256: of what it decodes them to;
    round_trip: that is the text, but that the whitespace mark itself reads as a space; parity: whether sentencepiece
    encodes and decodes all of the row alike. A null text is an empty one; repeated rows come back as often, and an
    empty table gives an empty one. A very long text, or word, is held whole by one task.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [x or "" for x in column(batch, "text").to_pylist()]
        flat, off, agree, back = codec.both_ways(texts)
        cuts, raw = off.tolist(), flat.astype("<i4")
        columns = [column(batch, "doc_id"), pa.array(np.diff(off)), pa.array([hashlib.sha256(raw[a:b].tobytes()).hexdigest() for a, b in zip(cuts, cuts[1:])]), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back]), pa.array([x == t.replace(MARK, " ") for x, t in zip(back, texts)]), pa.array(agree)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip", "parity"])

    return map_batches(_docs(docs, id_col, text_col), work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean, parity boolean", "text", BATCH_BYTES)
