"""Quality scores by Bradley-Terry pairwise ranking (operator 4).

A text becomes a short vector of surface measures (shares of kinds of
characters, word lengths, repetition of words, word pairs and lines, ...).  A
linear document score is learned from preference pairs (a text labelled 1
beats a text labelled 0) by logistic loss on the feature differences; the
decision threshold is the quantile of the training scores that leaves the
labelled share of rejected texts below it.  The reported score is the logistic
of the ranking score, scaled on the training rows and shifted so that the
threshold stands at 0.7.

Training reads at most ``max_train`` labelled texts (a documented bound); their
vectors, a few hundred bytes each, are fitted on the driver.  Scoring covers
every whole text in bounded slices.

Defined results: null and empty texts have all-zero shares and get the score of
that vector; repeated rows score alike; without labels of both kinds every text
scores 0.7 (kept); an empty table gives no rows; extra columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import byte_map, map_texts, mix64, utf8, words_of

KEEP = 0.7
#: Runs of anything but ASCII white space.
TOKEN = byte_map(lambda b: b > 0x20, lower=False)
LINE = byte_map(lambda b: b != 0x0A, lower=False)

_KINDS = {
    "lower": lambda b: 0x61 <= b <= 0x7A, "upper": lambda b: 0x41 <= b <= 0x5A,
    "digit": lambda b: 0x30 <= b <= 0x39, "blank": lambda b: b in (9, 10, 13, 32),
    "wide": lambda b: b >= 0x80, "stop": lambda b: b in b".,;:?'\"-()",
    "bang": lambda b: b == 0x21, "pipe": lambda b: b == 0x7C,
    "mark": lambda b: b in b"#$%&*@^~_=+<>/\\{}[]`",
}
_CLASS = np.full(256, len(_KINDS), np.int64)
for _i, _f in enumerate(_KINDS.values()):
    for _b in range(256):
        if _f(_b):
            _CLASS[_b] = _i
NAMES = [*(f"share_{k}" for k in _KINDS), "share_control", "any_mark", "any_bang", "any_pipe",
         "word_len", "word_len_sd", "distinct_words", "distinct_pairs", "top_word", "distinct_lines",
         "same_as_last", "words_per_line", "log_words", "single_words", "ends_marked", "shouted"]


def _distinct(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: number of different hashes, and the count of the commonest."""
    order = np.lexsort((h, row))
    r, v = row[order], h[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(r)))
    top = np.zeros(n)
    np.maximum.at(top, r[start], count)
    return np.bincount(r[start], minlength=n), top


def vectors(col: pa.Array) -> np.ndarray:
    """One row of measures for each text, in the order of ``NAMES``."""
    n = len(col)
    raw, offsets = utf8(col)
    size = np.diff(offsets)
    kinds = len(_KINDS) + 1
    at = np.repeat(np.arange(n) * kinds, size)
    share = np.bincount(at + _CLASS[raw], minlength=n * kinds).reshape(n, kinds).astype(float)
    share /= np.maximum(size, 1)[:, None]
    h, begin, end, row = words_of(raw, offsets, TOKEN)
    words = np.bincount(row, minlength=n)
    per = np.maximum(words, 1)
    length = (end - begin).astype(float)
    mean = np.bincount(row, length, minlength=n) / per
    sd = np.sqrt(np.maximum(np.bincount(row, length * length, minlength=n) / per - mean ** 2, 0))
    kinds_of, top = _distinct(row, h, n)
    same = row[1:] == row[:-1]
    with np.errstate(over="ignore"):
        pair = mix64(h[:-1] * np.uint64(0xA24BAED4963EE407) + h[1:])[same]
    pairs, _ = _distinct(row[1:][same], pair, n)
    again = np.bincount(row[1:][same], (h[1:] == h[:-1])[same], minlength=n)
    lh, _, _, lrow = words_of(raw, offsets, LINE)
    lines = np.bincount(lrow, minlength=n)
    distinct_lines, _ = _distinct(lrow, lh, n)
    last, first = raw[end - 1] if len(end) else raw[:0], raw[begin] if len(begin) else raw[:0]
    marked = np.isin(_CLASS[last], [list(_KINDS).index(k) for k in ("mark", "bang", "pipe")])
    up = list(_KINDS).index("upper")
    shouted = (_CLASS[first] == up) & (_CLASS[raw[np.minimum(begin + 1, max(len(raw) - 1, 0))]] == up) \
        if len(begin) else np.empty(0, bool)
    out = [share, share[:, [list(_KINDS).index(k) for k in ("mark", "bang", "pipe")]] > 0.005,
           np.stack([np.minimum(mean, 40) / 10, np.minimum(sd, 40) / 10, kinds_of / per,
                     pairs / np.maximum(words - 1, 1), top / per, distinct_lines / np.maximum(lines, 1),
                     again / per, np.log1p(words / np.maximum(lines, 1)), np.log1p(words),
                     words < 5, np.bincount(row, marked, minlength=n) / per,
                     np.bincount(row, shouted, minlength=n) / per], axis=1)]
    return np.concatenate(out, axis=1).astype(np.float64)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    threshold: float
    slope: float

    def rank(self, x: np.ndarray) -> np.ndarray:
        return (expand((x - self.mean) / self.scale) * self.weight).sum(1)    # row by row alike

    def score(self, x: np.ndarray) -> np.ndarray:
        s = np.clip(self.slope * (self.rank(x) - self.threshold) + np.log(KEEP / (1 - KEEP)), -35, 35)
        return 1.0 / (1.0 + np.exp(-s))


def expand(z: np.ndarray) -> np.ndarray:
    """Standardised measures, bounded, with their squares (too much and too little both count)."""
    z = np.clip(z, -6, 6)
    return np.concatenate([z, z * z / 6], axis=1)


def fit(x: np.ndarray, y: np.ndarray, pairs: int = 10_000, steps: int = 200, l2: float = 1e-3,
        seed: int = 5) -> Model:
    """Bradley-Terry by full-batch Adam over random (label 1, label 0) pairs."""
    mean, scale = (x.mean(0), np.maximum(x.std(0), 1e-3)) if len(x) else (np.zeros(len(NAMES)), np.ones(len(NAMES)))
    z = expand((x - mean) / scale)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    w = np.zeros(2 * len(NAMES))
    if not len(good) or not len(bad):
        return Model(mean, scale, w, 0.0, 1.0)
    rng = np.random.default_rng(seed)
    diff = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    m = v = np.zeros_like(w)
    for t in range(1, steps + 1):
        g = -(diff / (1 + np.exp(np.clip(diff @ w, -35, 35)))[:, None]).mean(0) + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
    s = z @ w
    order = np.sort(s)
    cut = len(bad)                         # the quantile of the rejected share
    threshold = (order[cut - 1] + order[min(cut, len(s) - 1)]) / 2
    # The logistic's slope: likelihood of the labels, the threshold held at 0.7.
    best = max((2.0 ** k for k in range(-6, 4)), key=lambda a: -np.logaddexp(
        0, np.where(y == 1, -1, 1) * (a * (s - threshold) + np.log(KEEP / (1 - KEEP)))).sum())
    return Model(mean, scale, w, float(threshold), float(best))


def train(sample: DataFrame, **options) -> Model:
    """Fit on a bounded sample (``doc_id, y, text``): vectors are computed on
    the executors, 25 doubles a row of the bounded sample are fitted on the driver."""
    rows = map_texts(sample.select("doc_id", "y", "text"), {"x": "array<double>"},
                     lambda col: {"x": list(vectors(col))}).orderBy("doc_id").collect()
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(NAMES))
    return fit(x, np.array([r["y"] for r in rows], int), **options)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """Replace the text by its quality score (0 to 1; kept from 0.7 on)."""
    return map_texts(docs, {name: "double"}, lambda col: {name: model.score(vectors(col))}, text_col)
