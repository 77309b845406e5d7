"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibrated output.

Words fall into hash buckets; each bucket has a fixed sparse random index vector of -1, 0 and 1, and its word vector is the
sum of the index vectors of the words beside it in a sample of texts (whole numbers, so the sum doesn't depend on order).
A document's vector is the mean over its words, and over its distinct words, with two figures on its length. Model and
vectors have a fixed size and are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACE, U64, keep_rows, map_texts, run_hashes, runs, share_of, slices, stored, texts_of, utf8

BITS, SIZE, WINDOW = 14, 48, 2
#: About so many labelled documents at most are learned from, and a part of them only for calibration.
SAMPLE, HIDDEN, EPOCHS, HOLD = 20_000, 32, 60, 5
THRESHOLD = 0.3
#: Buckets that travel together while word vectors are summed.
BLOCK = 1 << 10

_b = np.arange(256)
#: 0 for space, 1 for lower-case letters and bytes of other scripts, 2 for upper case, 3 for digits, the rest each a kind of its own.
KIND = np.where(SPACE, 0, np.where((_b >= 128) | (_b >= 97) & (_b <= 122), 1, np.where((_b >= 65) & (_b <= 90), 2, np.where((_b >= 48) & (_b <= 57), 3, _b + 4)))).astype(np.int16)


def tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every word: a run of letters of one case, of digits, or of one mark; a capital before small letters belongs to them."""
    kind = KIND[data]
    if len(kind) > 1:
        begins = np.zeros(len(kind) + 1, bool)
        begins[at] = True  # of rows: what stands before and after a byte counts only in its own
        capital = (kind[:-1] == 2) & (kind[1:] == 1) & ~begins[1:-1]
        lone = capital & (np.append(True, kind[:-2] != 2) | begins[:-2])
        kind = kind.copy()
        kind[:-1][lone] = 1
    start, end = runs(kind > 0, kind, at)
    row = np.searchsorted(at[1:], start, "right")
    h = run_hashes(LOWER[data], start, end) + (kind[start] == 2).astype(U64) * U64(0x9E3779B97F4A7C15)
    h *= U64(0xD6E8FEB86659FD93)
    return (h >> U64(64 - BITS)).astype(np.int64), row


def index_vectors() -> np.ndarray:
    """Six entries of each bucket's vector are 1 or -1."""
    rng = np.random.default_rng(5)
    out = np.zeros((1 << BITS, SIZE), np.int64)
    at = rng.random(out.shape).argpartition(6, axis=1)[:, :6]
    np.put_along_axis(out, at, rng.choice([-1, 1], at.shape), axis=1)
    return out


def word_vectors(rows: DataFrame) -> np.ndarray:
    """A unit vector per bucket, from the texts of rows. Tasks sum up what they read; what meets has a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = index_vectors(), np.zeros((1 << BITS, SIZE), np.int64)
        for batch in slices(batches):
            bucket, row = tokens(*utf8(batch.column("text")))
            for gap in range(1, WINDOW + 1):
                near = row[gap:] == row[:-gap]
                a, b = bucket[gap:][near], bucket[:-gap][near]
                pair, n = np.unique(np.append(a << BITS | b, b << BITS | a), return_counts=True)
                to, cut = np.unique(pair >> BITS, return_index=True)
                if len(to):
                    total[to] += np.add.reduceat(index[pair & ((1 << BITS) - 1)] * n[:, None], cut, axis=0)
        for lo in range(0, 1 << BITS, BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([total[lo : lo + BLOCK].tobytes()], pa.binary())], names=["block", "total"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:  # a row per task at most
        total = sum((np.frombuffer(raw, np.int64) for raw in frame["total"]), np.zeros(BLOCK * SIZE, np.int64))
        return pd.DataFrame({"block": frame["block"][:1], "total": [total.tobytes()]})

    found = rows.select("text").coalesce(16).mapInArrow(run, "block long, total binary").groupBy("block").applyInPandas(add, "block long, total binary").collect()
    out = np.zeros((1 << BITS, SIZE), np.float32)
    for r in found:
        out[r["block"] : r["block"] + BLOCK] = np.frombuffer(r["total"], np.int64).reshape(BLOCK, SIZE)
    # A bucket that was not met has its index vector alone.
    out = np.where(out.any(axis=1, keepdims=True), out, index_vectors())
    return (out / np.linalg.norm(out, axis=1, keepdims=True)).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """The vector of each row's text."""
    data, at = utf8(column)
    bucket, row = tokens(data, at)
    rows = len(at) - 1
    n = np.bincount(row, minlength=rows)
    out = np.zeros((rows, 2 * SIZE + 3), np.float32)
    if len(bucket):
        cell, count = np.unique(row << BITS | bucket, return_counts=True)
        owner, cut = np.unique(cell >> BITS, return_index=True)
        v = vectors[cell & ((1 << BITS) - 1)]
        distinct = np.diff(np.append(cut, len(cell)))
        out[owner, :SIZE] = np.add.reduceat(v * count[:, None], cut, axis=0) / n[owner, None]
        out[owner, SIZE : 2 * SIZE] = np.add.reduceat(v, cut, axis=0) / distinct[:, None]
        out[owner, -2] = distinct / n[owner]
    out[:, -3] = np.log1p(n) / 8
    out[:, -1] = 1
    return out


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    second: np.ndarray
    temperature: float
    low: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The calibrated probability of label 1."""
        hidden = np.tanh((x - self.mean) / self.scale @ self.first)
        z = (hidden @ self.second[:-1] + self.second[-1]) / self.temperature
        return np.clip(1 / (1 + np.exp(-np.clip(z, -60, 60))), self.low, 1 - self.low)


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Adam over shuffled batches, log loss, a small ridge."""
    rng = np.random.default_rng(3)
    params = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.append(rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), 128):
            t, pick = t + 1, order[lo : lo + 128]
            h = np.tanh(x[pick] @ params[0])
            p = 1 / (1 + np.exp(-np.clip(h @ params[1][:-1] + params[1][-1], -60, 60)))
            d = (p - y[pick]) / len(pick)
            back = d[:, None] * params[1][:-1] * (1 - h * h)
            grads = [x[pick].T @ back, np.append(h.T @ d, d.sum())]
            for i, g in enumerate(grads):
                g = g + 1e-4 * params[i]
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                params[i] = params[i] - 0.004 * (1 - epoch / EPOCHS) * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return params[0], params[1]


def _calibrate(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on documents the network has not seen."""
    if not len(z):
        return 1.0
    grid = np.geomspace(0.25, 16, 121)
    loss = [np.mean(np.logaddexp(0, z / t) - y * z / t) for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(docs: DataFrame, labels: DataFrame, allowed: Column, sample: int = SAMPLE) -> Model | None:
    """A model from labelled rows where allowed holds (a condition on doc_id); None unless both labels are there.

    The sample is chosen by a hash of the id and is the only thing of which more than sums reaches the driver. An id with both
    labels counts as 1; rows of one id and without text are each learned from, or left out, by themselves.
    """
    known = labels.where(allowed & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    by = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(by) < 2:
        return None
    chosen = known.where(share_of(F.col("doc_id"), sample, sum(by.values())))
    rows = stored(docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id"), "labelled")  # about `sample` rows
    vectors = word_vectors(rows)
    held = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = pooled(batch.column("text"), held.value)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "quality", "x"])

    got = sorted(map(tuple, map_texts(rows, run, "doc_id long, quality int, x binary").collect()))
    if not got:  # labels, but no texts of theirs
        return None
    x, y = np.array([np.frombuffer(r[2], np.float32) for r in got], np.float64), np.array([r[1] for r in got], float)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    mean[-1], scale[-1] = 0, 1  # the constant stays
    z = (x - mean) / scale
    apart = np.arange(len(z)) % HOLD == 0
    learn = ~apart if len(set(y[~apart])) == 2 and apart.sum() >= 20 else np.ones(len(z), bool)
    first, second = _fit(z[learn], y[learn])
    logits = np.tanh(z[apart] @ first) @ second[:-1] + second[-1]
    temperature = _calibrate(logits, y[apart]) if not learn.all() else 1.0
    return Model(vectors, mean, scale, first, second, temperature, 1e-6)


def _probability(model: Model | None, texts: pa.Array) -> np.ndarray:
    return model.score(pooled(texts, model.vectors)) if model else np.full(len(texts), 0.5)


def score(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted (1 if score >= threshold) of each whole text; null text counts as empty.

    Without a model every score is 0.5. One row out per row in, also for repeated rows; equal texts have equal scores.
    """
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = _probability(held.value, batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return map_texts(texts_of(df, id_col, text_col), run, "doc_id long, score double, predicted int")


def keep(df: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of df that score() predicts 1 for, with all their columns."""
    held = df.sparkSession.sparkContext.broadcast(model)
    return keep_rows(df, text_col, lambda texts: _probability(held.value, texts) >= threshold)
