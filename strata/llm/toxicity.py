"""Toxicity scores by FTRL-proximal logistic regression (operator 7).

Features are the presence of hashed word unigrams, bigrams and one-word
skip-grams (word, any word, word) of the whole text.  Training is
FTRL-proximal: per-coordinate learning rates from the sums of squared
gradients, and an L1 bound that keeps the weight of a feature at exactly zero
until its gradients agree; what remains is a short list of non-zero weights,
which is broadcast (at most ``BUCKETS`` floats, 4 MB dense).

Training reads at most ``max_train`` labelled texts (a documented bound,
the first by md5 of the id) in one task that holds only feature ids;
scoring covers every text in bounded slices.

Defined results: null and empty texts have no features and score as the bias
alone; repeated rows score alike; a text of any length is scored whole; no
labels at all give a score of 0.5 everywhere; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import ALNUM, map_texts, mix64, utf8, words_of

BITS = 20
BUCKETS = 1 << BITS
_BI, _SKIP = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


def features(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every n-gram and skip-gram occurrence of the texts."""
    raw, offsets = utf8(col)
    h, _, _, row = words_of(raw, offsets, ALNUM)
    ids, rows = [h], [row]
    with np.errstate(over="ignore"):
        for gap, salt in ((1, _BI), (2, _SKIP)):
            same = row[gap:] == row[:-gap]
            ids.append(mix64(h[:-gap][same] * salt + h[gap:][same]))
            rows.append(row[gap:][same])
    return ((np.concatenate(ids) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(rows))


@dataclass(frozen=True)
class Model:
    """Bias and the non-zero weights."""

    bias: float
    index: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        w = np.zeros(BUCKETS, np.float64)
        w[self.index] = self.weight
        return w


def ftrl(examples: list[np.ndarray], y: np.ndarray, alpha: float = 2.0, beta: float = 1.0,
         l1: float = 15.0, l2: float = 0.0, epochs: int = 10, weight: float = 4.0,
         seed: int = 3) -> Model:
    """FTRL-proximal over examples of distinct feature ids (bias without L1).

    ``weight`` multiplies the gradient of the rarer label 1, so that missing a
    toxic text costs more than doubting a clean one."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    order = np.random.default_rng(seed)

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        bound = np.full(len(zi), l1)
        bound[-1] = 0.0
        return np.where(np.abs(zi) <= bound, 0.0,
                        -(zi - np.sign(zi) * bound) / ((beta + np.sqrt(ni)) / alpha + l2))

    ids = [np.append(e, BUCKETS) for e in examples]
    for _ in range(epochs):
        for i in order.permutation(len(ids)):
            at = ids[i]
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y[i]
            g *= weight if y[i] else 1.0
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[at] = zi + g - step * w
            n[at] = ni + g * g
    w = weights(z, n)
    index = np.flatnonzero(w[:-1])
    return Model(float(w[-1]), index, w[index])


def train(sample: DataFrame, **options) -> Model:
    """Fit on a bounded sample (``doc_id, y, text``) in one task; only the
    non-zero weights come back."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed: list[tuple[int, int, np.ndarray]] = []
        for b in batches:
            for doc, y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                ids, _ = features(pa.array([text.as_py()], pa.large_string()))
                keyed.append((doc, y, np.unique(ids).astype(np.int32)))
        keyed.sort(key=lambda k: k[0])       # one order at every partitioning
        m = ftrl([k[2] for k in keyed], np.array([k[1] for k in keyed], float), **options)
        yield pa.RecordBatch.from_pydict(
            {"i": np.append(m.index, BUCKETS).astype(np.int64), "w": np.append(m.weight, m.bias)})

    rows = sample.select("doc_id", "y", "text").coalesce(1).mapInArrow(fit, "i long, w double").collect()
    i = np.array([r["i"] for r in rows], np.int64)
    w = np.array([r["w"] for r in rows], float)
    return Model(float(w[i == BUCKETS].sum()), i[i < BUCKETS], w[i < BUCKETS])


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """Replace the text by its toxicity score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(col: pa.Array) -> dict:
        m = shared.value
        dense = m.dense()
        ids, rows = features(col)
        hit = dense[ids] != 0                       # few: the weights are sparse
        pair = np.unique(rows[hit] * BUCKETS + ids[hit])
        total = np.bincount(pair // BUCKETS, dense[pair % BUCKETS], minlength=len(col)) + m.bias
        return {name: 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))}

    return map_texts(docs, {name: "double"}, run, text_col)
