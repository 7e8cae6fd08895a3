"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme-value statistics.

Token scores are log-odds ratios of toxic against clean documents with Beta (two-class Dirichlet) priors: a word's
prior is the rate of its longest prefix, each prefix's prior is the rate of the next shorter one, and the shortest one's
is the rate of all documents. Document frequencies are counted, so one document's repetitions weigh once. Words
without positive evidence cost a constant. All maximal scoring segments of a text are found in one pass; a segment of
score S among n words has the evidence lambda * S - ln(K * n) of the extreme-value law, with lambda and K from clean
training documents. Segments of small p-value are the passages; the largest evidence and the sum over passages are
combined into one probability. Its weights are fitted on the halves of the sample that the token scores of the other
half did not come from.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, crc_fold, map_batches, text_bytes
from .labelled import training_rows
from .words import words

#: Lengths in bytes of the prefixes that stand in for words too rare to be judged, shortest first.
PREFIXES = range(3, 10)
#: Pseudo-documents of a prior; least log-odds of a token that counts; cost of any other word; p-value of a passage.
PRIOR, LEAST, COST, SIGNIFICANT = 10.0, 2.0, 0.5, 0.01
THRESHOLD, FOLDS, HELD_OUT = 0.7, 3, 1
#: Words whose scores a task keeps at hand.
CACHED = 300_000
#: Evidence of a text without any token that counts.
FLOOR = -8.0


@dataclass
class Model:
    scores: dict[bytes, float]  # of words and, with a trailing "*", of prefixes; 0 ends the search for a shorter one
    lam: float = 1.0
    k: float = 0.1
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)


def word_score(model: Model, word: bytes) -> float:
    """Score of the word itself or else of its longest prefix that has one."""
    s = model.scores.get(word)
    for n in reversed(PREFIXES):
        if s is not None:
            return s
        if n < len(word):
            s = model.scores.get(word[:n] + b"*")
    return s or 0.0


def token_scores(model: Model, w: list[bytes], cache: dict[bytes, float] | None = None) -> list[tuple[int, float]]:
    """(position, score) of the words that count. A cache keeps the scores of words seen before."""
    cache, out = {} if cache is None else cache, []
    for i, x in enumerate(w):
        s = cache.get(x)
        if s is None:
            s = cache[x] = word_score(model, x)
        if s:
            out.append((i, s))
    return out


def maximal_segments(hits: list[tuple[int, float]], cost: float = COST) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence whose words score as in `hits`, else -cost.

    Linear time: each candidate keeps the cumulative score before and after it and a link to the nearest earlier
    candidate that starts lower, so a merge never looks at a candidate twice.
    """
    segs: list[list] = []  # start, end, before, after, link
    total, at = 0.0, 0
    for i, s in hits:
        total -= cost * (i - at)
        new = [i, i + 1, total, total + s, -1]
        total, at = total + s, i + 1
        j = len(segs) - 1
        while True:
            while j >= 0 and segs[j][2] >= new[2]:
                j = segs[j][4]
            if j < 0 or segs[j][3] >= new[3]:
                new[4] = j
                segs.append(new)
                break
            new[0], new[2] = segs[j][0], segs[j][2]
            link = segs[j][4]
            del segs[j:]
            j = link
    return [(a, b, after - before) for a, b, before, after, _ in segs]


def evidence(model: Model, n: int, segs: list[tuple[int, int, float]]) -> list[tuple[int, int, float, float]]:
    """(start, end, evidence, p-value) of each segment among n words."""
    out = []
    for a, b, s in segs:
        e = model.lam * s - math.log(max(model.k * n, 1e-9))
        out.append((a, b, e, -math.expm1(-math.exp(min(50.0, -e)))))
    return out


def _summary(found: list[tuple[int, int, float, float]]) -> tuple[float, float]:
    most = max((e for _, _, e, _ in found), default=FLOOR)
    return max(most, FLOOR), math.log1p(sum(max(e, 0.0) for _, _, e, p in found if p <= SIGNIFICANT))


def score(model: Model, found: list[tuple[int, int, float, float]]) -> float:
    a, b = _summary(found)
    z = model.weights[0] + model.weights[1] * a + model.weights[2] * b
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def lexicon(docs: list[list[bytes]], y: list[int], base: float) -> dict[bytes, float]:
    """Log-odds of words and prefixes, where a word's own differ from what its prefixes say."""
    toxic, every = Counter(), Counter()
    for w, v in zip(docs, y):
        kinds = set(w)
        keys = kinds | {x[:n] + b"*" for x in kinds for n in PREFIXES if n < len(x)}
        every.update(keys)
        if v:
            toxic.update(keys)
    rates: dict[bytes, float] = {}
    prior = math.log(base / (1 - base))

    def rate(key: bytes) -> float:
        """Posterior mean; a key that adds no document to its parent's keeps the parent's rate."""
        if key in rates:
            return rates[key]
        size = len(key) - key.endswith(b"*")
        up = next((key[:n] + b"*" for n in reversed(PREFIXES) if n < size), None)
        parent = rate(up) if up else base
        n = every[key]
        rates[key] = parent if up and every[up] == n else (toxic[key] + PRIOR * parent) / (n + PRIOR)
        return rates[key]

    out: dict[bytes, float] = {}
    for key in sorted(every, key=lambda k: (len(k) - k.endswith(b"*"), not k.endswith(b"*"), k)):
        r = rate(key)
        s = math.log(r / (1 - r)) - prior
        s = s if s >= LEAST else 0.0
        size = len(key) - key.endswith(b"*")
        above = next((out[u] for n in reversed(PREFIXES) if n < size and (u := key[:n] + b"*") in out), 0.0)
        if s != above:
            out[key] = s
    return out


def _law(model: Model, docs: list[tuple[int, list]]) -> None:
    """Lambda and K of the extreme-value law from (words, scores) of clean texts."""
    dist = Counter(round(s, 1) for _, h in docs for _, s in h)
    size = sum(n for n, _ in docs)
    rest = size - sum(dist.values())
    lo, hi = 0.05, 1.0  # 1 is the natural scale of log-odds; a larger root only says that clean texts hardly score
    for _ in range(40):
        mid = (lo + hi) / 2
        mean = (rest * math.exp(-mid * COST) + sum(c * math.exp(mid * s) for s, c in dist.items())) / max(size, 1)
        lo, hi = (mid, hi) if mean < 1 else (lo, mid)
    tops = [(n, max((s for *_, s in maximal_segments(h)), default=0.0)) for n, h in docs]
    model.lam, model.k = lo, max(len(tops), 1) / max(sum(n * math.exp(-lo * s) for n, s in tops), 1e-9)


def fit(texts: list[bytes], y: list[int]) -> Model:
    """Scores, extreme-value law and weights of a labelled sample. Without both classes nothing counts as toxic and all score alike."""
    docs = [words(t) for t in texts]
    n1, n0 = sum(1 for v in y if v), sum(1 for v in y if not v)
    base = (n1 + 1) / (n1 + n0 + 2)
    prior = math.log(base / (1 - base))
    if not n1 or not n0:
        return Model({}, weights=(prior, 0.0, 0.0))
    half = [zlib.crc32(t) & 1 for t in texts]  # copies stay together
    clean, others = [], []
    for h in (0, 1):
        part = Model(lexicon([d for d, i in zip(docs, half) if i == h], [v for v, i in zip(y, half) if i == h], base))
        scored = [(len(d), token_scores(part, d), v) for d, v, i in zip(docs, y, half) if i != h]
        clean += [(n, s) for n, s, v in scored if not v and n]
        others += scored
    model = Model(lexicon(docs, y, base))
    _law(model, clean)
    x = np.array([(1.0, *_summary(evidence(model, n, maximal_segments(s)))) for n, s, _ in others])
    t, beta = np.array([v for *_, v in others], float), np.array([prior, 0.0, 0.0])
    ridge = np.diag([0.0, 1.0, 1.0])

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(np.sum(np.logaddexp(0, z) - t * z) + b @ ridge @ b / 2)

    for _ in range(60):  # Newton, halved until the loss falls
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-6 * np.eye(3), x.T @ (p - t) + ridge @ beta)
        while np.abs(step).max() > 1e-9 and loss(beta - step) > loss(beta):
            step = step / 2
        beta = beta - step
        if np.abs(step).max() < 1e-8:
            break
    model.weights = tuple(beta.tolist())
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT) -> Model:
    rows = sorted((r.text.encode(), r.y) for r in training_rows(docs, labels, label, folds, held_out, id_col=id_col, text_col=text_col).collect())  # bounded: SAMPLE_DOCS
    return fit([t for t, _ in rows], [v for _, v in rows])


def passages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, passages) of each row; passages are (start, end, evidence, p_value) in words, significant ones only.

    Null and empty texts have no passages and the score of a text in which nothing counts. Repeated rows come back as often,
    an empty table gives an empty one, and other columns are not looked at. Equal texts score alike.
    """
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("evidence", pa.float64()), ("p_value", pa.float64())]))

    cache: dict[bytes, float] = {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, spans = [], []
        if len(cache) > CACHED:
            cache.clear()
        for text in text_bytes(column(batch, "text")):
            w = words(text)
            found = evidence(model, len(w), maximal_segments(token_scores(model, w, cache)))
            out.append(score(model, found))
            spans.append([{"start": a, "end": b, "evidence": e, "p_value": p} for a, b, e, p in found if p <= SIGNIFICANT])
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(out, pa.float64()), pa.array(spans, kind)], names=["doc_id", "score", "passages"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), work, "doc_id long, score double, passages array<struct<start:int,end:int,evidence:double,p_value:double>>", "text")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """(doc_id, held_out, score, predicted, passages) of each row; labels of the held-out fold are never read."""
    found = passages(docs, train(docs, labels, folds=folds, held_out=held_out))
    return found.select("doc_id", (crc_fold("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")
