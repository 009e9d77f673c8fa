"""Quality classifier by positive-unlabelled learning.

Trusted positives, unlabelled texts and an estimated class prior train a small
network by the non-negative unbiased risk

    prior * E_p[loss(f, +1)] + max(0, E_u[loss(f, -1)] - prior * E_p[loss(f, -1)])

with logistic loss, so the output is the log-odds of a good text.  Rows marked
bad are not used as negatives; they only enter the prior, the share of
positives among the trusted marks.  Features are of the text alone: shares of
character-class pairs, word counts, repetition at short distance.

Training takes at most ``SAMPLE`` positives and ``SAMPLE`` unlabelled texts,
those with the least hash of their id; their features (a few hundred bytes
each) are what comes to the driver.  Every text is scored, whole.

Defined results: a null text is an empty one and is scored; an id with several
marks is trusted as positive only if all say so; marks that are null or of
unknown ids are left out; without a positive or unlabelled text every score is
the prior (0.5 without marks); repeated rows are scored each; an empty table
gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import hash_words, texts

SAMPLE = 6000       # most positives, and most unlabelled texts, that training takes
EPOCHS = 300
HIDDEN = 12
THRESHOLD = 0.7

# character classes of bytes: lower, upper, digit, space, line feed, sentence marks, other ASCII, beyond ASCII
_CLASS = np.full(256, 6, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9, 13]], _CLASS[10], _CLASS[128:] = 3, 4, 7
_CLASS[[ord(c) for c in ".,;:'\"()-"]] = 5
_KINDS = 8
N_FEATURES = _KINDS * _KINDS + 8


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features per text ``data[offsets[i]:offsets[i+1]]``."""
    n = len(offsets) - 1
    out = np.zeros((n, N_FEATURES), np.float32)
    size = np.diff(offsets)
    body = _CLASS[data[offsets[0]:offsets[-1]]].astype(np.int64)
    doc = np.repeat(np.arange(n), size)
    if len(body) > 1:
        same = doc[1:] == doc[:-1]
        pair = (doc[:-1] * _KINDS + body[:-1]) * _KINDS + body[1:]
        pairs = np.bincount(pair[same], minlength=n * _KINDS * _KINDS).reshape(n, -1)
        out[:, :_KINDS * _KINDS] = np.sqrt(pairs / np.maximum(size - 1, 1)[:, None])
    h, at = hash_words(data, offsets)
    words = np.diff(at)
    owner = np.repeat(np.arange(n), words)
    k = _KINDS * _KINDS
    out[:, k] = np.log1p(words)
    out[:, k + 1] = words == 0
    out[:, k + 2] = np.log1p(size / np.maximum(words, 1))
    near = np.zeros(len(h), bool)
    for gap in (1, 2, 3, 5, 8):
        hit = np.zeros(len(h), bool)
        if len(h) > gap:
            hit[gap:] = (h[gap:] == h[:-gap]) & (owner[gap:] == owner[:-gap])
        near |= hit
        if gap in (1, 3):
            out[:, k + (3 if gap == 1 else 4)] = np.bincount(owner, weights=hit, minlength=n) / np.maximum(words, 1)
    out[:, k + 5] = np.bincount(owner, weights=near, minlength=n) / np.maximum(words, 1)
    lines = np.bincount(doc, weights=body == 4, minlength=n) + 1
    out[:, k + 6] = np.log1p(words / lines)
    out[:, k + 7] = np.log1p(lines)
    return out


class Model:
    """Standardised features through one hidden layer; ``score`` is the probability of a good text."""

    def __init__(self, prior: float):
        self.prior, self.weights = prior, None

    def _forward(self, x):
        a, b, c, d = self.weights
        z = np.tanh(x @ a + b)
        return z, z @ c + d[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        _, f = self._forward((x - self.mean) / self.scale)
        return 1 / (1 + np.exp(-np.clip(f, -30, 30)))

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
        if not len(positive) or not len(unlabelled):
            return self
        both = np.concatenate([positive, unlabelled]).astype(np.float64)
        self.mean, self.scale = both.mean(0), both.std(0) + 1e-3
        p, u = (positive - self.mean) / self.scale, (unlabelled - self.mean) / self.scale
        rng = np.random.default_rng(seed)
        w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)) for x in (p,)]
        self.weights = [w[0], np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        m = [np.zeros_like(x) for x in self.weights]
        v = [np.zeros_like(x) for x in self.weights]
        for t in range(1, epochs + 1):
            zp, fp = self._forward(p)
            zu, fu = self._forward(u)
            up, uu = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
            negative = np.logaddexp(0, fu).mean() - self.prior * np.logaddexp(0, fp).mean()
            # derivatives of the risk by the outputs; a negative part below zero is climbed instead
            if negative >= 0:
                gp = self.prior * ((up - 1) - up) / len(p)
                gu = uu / len(u)
            else:
                gp, gu = self.prior * up / len(p), -uu / len(u)
            grads = [np.zeros_like(x) for x in self.weights]
            for x, z, g in ((p, zp, gp), (u, zu, gu)):
                back = np.outer(g, self.weights[2]) * (1 - z * z)
                for i, part in enumerate((x.T @ back, back.sum(0), z.T @ g, g.sum(keepdims=True))):
                    grads[i] += part
            for i, g in enumerate(grads):
                g = g + 1e-4 * self.weights[i]
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                self.weights[i] = self.weights[i] - 0.02 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        return self


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in texts(batch.column("text")):
            x = features(data, offsets)
            yield pa.record_batch({"kind": batch.column("kind").slice(lo, hi - lo),
                                   "x": pa.array(list(x), pa.list_(pa.float32()))})


def train(docs: DataFrame, marks: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark_col: str = "quality",
          sample: int = SAMPLE) -> Model:
    """Fit on trusted ``marks`` (id, 0/1), which hold only rows that training may see, and unlabelled ``docs``."""
    trusted = marks.select(F.col(id_col).alias("id"), F.col(mark_col).alias("mark")).where("id is not null and mark is not null") \
        .groupBy("id").agg(F.min("mark").alias("mark"))
    share = trusted.agg(F.avg((F.col("mark") == 1).cast("double"))).first()[0]
    prior = min(max(0.5 if share is None else share, 0.01), 0.99)

    def least(ids: DataFrame, seed: int, kind: int) -> DataFrame:
        return ids.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample).select("id", F.lit(kind).alias("kind"))

    every = docs.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    chosen = least(trusted.where("mark = 1").select("id"), 1, 1).unionByName(least(every, 2, 0))
    # at most two samples of ids, so the join leaves the texts where they are
    taken = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .join(F.broadcast(chosen), "id").select("kind", "text")
    table = taken.mapInArrow(_feature_rows, "kind int, x array<float>").toArrow()
    kind = table.column("kind").to_numpy()
    x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(kind), N_FEATURES) \
        if len(kind) else np.zeros((0, N_FEATURES))
    order = np.lexsort(x.T) if len(kind) else np.empty(0, np.int64)  # the same model whatever the order of arrival
    x, kind = x[order].astype(np.float64), kind[order]
    return Model(prior).fit(x[kind == 1], x[kind == 0])


def score(text: Column, model: Model) -> Column:
    """Score of a text column, 0 to 1."""
    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            out = [model.score(features(data, offsets))
                   for _, _, data, offsets in texts(pa.Array.from_pandas(part, type=pa.string()))]
            yield pd.Series(np.concatenate(out) if out else np.empty(0), dtype="float64")

    return run(F.coalesce(text, F.lit("")))


def held_out(id_col: Column) -> Column:
    """The fold that training never sees: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4 == 2
