"""Quality classifier: a byte-level convolutional network in numpy.

Filters run over every byte position of the whole text. The positions are cut into overlapping chunks (two adjacent
blocks each), each filter is max-pooled within a chunk, and the mean and the maximum of the chunks' pooled vectors go
through one logistic unit. Filters, byte embedding and the unit are learned with Adam on a bounded labelled sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, crc_fold, map_batches, text_buffers
from .labelled import training_rows

#: Bytes that a filter sees, filters, embedding size, bytes in a block (half a chunk).
WIDTH, FILTERS, EMBED, BLOCK = 6, 16, 8, 128
THRESHOLD, FOLDS, HELD_OUT = 0.3, 5, 0
EPOCHS, BATCH, RATE, SEED = 14, 32, 0.01, 11


@dataclass
class Model:
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # WIDTH x EMBED x FILTERS
    bias: np.ndarray  # FILTERS
    out: np.ndarray  # 2 * FILTERS
    out_bias: float

    def __post_init__(self):
        self._pairs = None

    def __getstate__(self):
        return self.__dict__ | {"_pairs": None}

    def tables(self) -> np.ndarray:
        """WIDTH x 256 x FILTERS: what a byte at a place within the filter adds."""
        return np.einsum("be,kef->kbf", self.embed, self.filters).astype(np.float32)

    def pair_tables(self) -> list[np.ndarray]:
        """The same for each two places at once: 65,536 x FILTERS, by first byte * 256 + second byte."""
        if self._pairs is None:
            t = self.tables()
            self._pairs = [(t[k][:, None, :] + t[k + 1][None, :, :]).reshape(65536, -1) for k in range(0, WIDTH, 2)]
        return self._pairs


def _pad(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts end to end, each filled with zero bytes to whole blocks and at least WIDTH - 1 zeros; blocks' starts of each text; text of each block."""
    sizes = np.diff(offsets)
    blocks = (sizes + WIDTH - 1 + BLOCK - 1) // BLOCK
    first = np.r_[0, np.cumsum(blocks)]
    x = np.zeros(first[-1] * BLOCK + WIDTH, np.uint8)
    x[np.arange(len(raw)) + np.repeat(first[:-1] * BLOCK - offsets[:-1], sizes)] = raw
    return x, first, np.repeat(np.arange(len(sizes)), blocks)


def _closed(z: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Activations by block; the end of a text's last block, mere filling from where a filter would see the next text, is shut out."""
    z = z.reshape(-1, BLOCK, FILTERS)
    z[last, BLOCK - WIDTH + 1 :] = -np.inf
    return z


def _chunks(block_max: np.ndarray, first: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Maximum over each block and the next one of the same text; a text's last block stands alone."""
    out = block_max.copy()
    same = np.flatnonzero(of[:-1] == of[1:])
    out[same] = np.maximum(block_max[same], block_max[same + 1])
    return out


def features(model: Model, raw: np.ndarray, offsets: np.ndarray, step: int = 1 << 15) -> np.ndarray:
    """Mean and maximum over the chunks of each text of the pooled, rectified filters: n x 2 FILTERS."""
    x, first, of = _pad(raw, offsets)
    pairs = (x[:-1].astype(np.uint16) << 8) | x[1:]
    tables, n = model.pair_tables(), first[-1] * BLOCK
    tops, last = np.empty((first[-1], FILTERS), np.float32), np.r_[of[1:] != of[:-1], True]
    for at in range(0, n, step):
        end = min(at + step, n)
        z = tables[0][pairs[at:end]]
        for k in range(1, WIDTH // 2):
            z += tables[k][pairs[at + 2 * k : end + 2 * k]]
        tops[at // BLOCK : end // BLOCK] = _closed(z, last[at // BLOCK : end // BLOCK]).max(axis=1)
    pooled = np.maximum(_chunks(tops, first, of) + model.bias.astype(np.float32), 0)
    mean = np.add.reduceat(pooled, first[:-1], axis=0) / np.diff(first)[:, None]
    return np.hstack([mean, np.maximum.reduceat(pooled, first[:-1], axis=0)])


def score(model: Model, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if len(offsets) < 2:
        return np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(features(model, raw, offsets) @ model.out + model.out_bias, -30, 30)))


def fit(texts: list[bytes], y: list[int], epochs: int = EPOCHS) -> Model:
    """Adam on the log loss with both classes at their own rates; the gradient runs through the pooled positions only.

    Rows are put in an order of their own first, so equal samples give equal models. Without rows the score is 0.5.
    """
    rng = np.random.default_rng(SEED)
    order = sorted(range(len(texts)), key=lambda i: (len(texts[i]), texts[i], y[i]))
    texts, target = [texts[i] for i in order], np.array([y[i] for i in order], np.float64)
    p = {"embed": rng.normal(0, 0.5, (256, EMBED)), "filters": rng.normal(0, 0.4, (WIDTH, EMBED, FILTERS)), "bias": np.zeros(FILTERS), "out": rng.normal(0, 0.2, 2 * FILTERS), "out_bias": np.zeros(1)}
    if len(target):
        rate = (target.sum() + 1) / (len(target) + 2)
        p["out_bias"][0] = np.log(rate / (1 - rate))
    m1, m2, t = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for epoch in range(epochs if len(texts) else 0):
        perm = rng.permutation(len(texts))
        for at in range(0, len(perm), BATCH):
            ids = perm[at : at + BATCH]
            raw = np.frombuffer(b"".join(texts[i] for i in ids), np.uint8)
            offsets = np.r_[0, np.cumsum([len(texts[i]) for i in ids])]
            g = _gradients(p, raw, offsets, target[ids])
            t += 1
            pace = RATE * min(1, (epochs - epoch) / (0.4 * epochs))
            for k in p:
                m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                m2[k] = 0.99 * m2[k] + 0.01 * g[k] ** 2
                p[k] -= pace * m1[k] / (1 - 0.9**t) / (np.sqrt(m2[k] / (1 - 0.99**t)) + 1e-8)
    return Model(p["embed"], p["filters"], p["bias"], p["out"], float(p["out_bias"][0]))


def _gradients(p: dict[str, np.ndarray], raw: np.ndarray, offsets: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
    x, first, of = _pad(raw, offsets)
    n = first[-1] * BLOCK
    tables = np.einsum("be,kef->kbf", p["embed"], p["filters"]).astype(np.float32)
    z = tables[0][x[:n]]
    for k in range(1, WIDTH):
        z += tables[k][x[k : n + k]]
    z = _closed(z, np.r_[of[1:] != of[:-1], True])
    where = z.argmax(axis=1) + np.arange(len(z))[:, None] * BLOCK
    tops = np.take_along_axis(z.reshape(-1, FILTERS), where, axis=0)
    same = np.flatnonzero(of[:-1] == of[1:])
    chunk, at = tops.copy(), where.copy()
    later = tops[same + 1] > tops[same]
    chunk[same] = np.where(later, tops[same + 1], tops[same])
    at[same] = np.where(later, where[same + 1], where[same])
    pooled = np.maximum(chunk + p["bias"], 0)
    count = np.diff(first)[:, None]
    mean, most = np.add.reduceat(pooled, first[:-1], axis=0) / count, np.maximum.reduceat(pooled, first[:-1], axis=0)
    feats = np.hstack([mean, most])
    d = (1 / (1 + np.exp(-np.clip(feats @ p["out"] + p["out_bias"], -30, 30))) - target) / len(target)
    top = (pooled == most[of]).astype(np.float64)  # overlapping chunks often share their maximum: they share the gradient
    top /= np.add.reduceat(top, first[:-1], axis=0)[of]
    back = d[of, None] * (p["out"][None, :FILTERS] / count[of] + p["out"][None, FILTERS:] * top)
    back *= pooled > 0
    g_tables = np.zeros_like(tables, np.float64)
    cols = np.broadcast_to(np.arange(FILTERS), at.shape)
    for k in range(WIDTH):
        np.add.at(g_tables[k], (x[at + k], cols), back)
    l2 = 1e-5
    return {
        "embed": np.einsum("kbf,kef->be", g_tables, p["filters"]) + l2 * p["embed"],
        "filters": np.einsum("kbf,be->kef", g_tables, p["embed"]) + l2 * p["filters"],
        "bias": back.sum(axis=0),
        "out": feats.T @ d + l2 * p["out"],
        "out_bias": np.array([d.sum()]),
    }


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT) -> Model:
    rows = training_rows(docs, labels, label, folds, held_out, id_col=id_col, text_col=text_col).collect()  # bounded: SAMPLE_DOCS
    return fit([r.text.encode() for r in rows], [r.y for r in rows])


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(doc_id, score) of each row, from its whole text alone. Null and empty texts have the score of a chunk of zeros."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        off, raw = text_buffers(column(batch, "text"))
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(score(model, raw, off))], names=["doc_id", "score"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), work, "doc_id long, score double", "text", 1 << 20)


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, whose score is at least the threshold; repeated rows stay or go together."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        off, raw = text_buffers(column(batch, text_col))
        return batch.filter(pa.array(score(model, raw, off) >= threshold))

    return map_batches(docs, work, docs.schema, text_col, 1 << 20)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row; labels of the held-out fold are never read.

    Equal texts score alike, null and empty ones as a chunk of zeros; repeated rows come back as often; a score at the
    threshold is predicted; other columns are not looked at, whatever their names; an empty table gives an empty one.
    """
    found = scores(docs, train(docs, labels, folds=folds, held_out=held_out))
    return found.select("doc_id", (crc_fold("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
