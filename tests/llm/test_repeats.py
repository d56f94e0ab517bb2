import random
import re

import numpy as np
import pytest

from strata.llm import repeats as R
from tests.llm.helpers import awkward, docs_of, empty


@pytest.fixture(autouse=True)
def few_groups(monkeypatch):
    monkeypatch.setattr(R, "MIN_GROUPS", 16)


def words_of(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]


def brute(rows, size):
    """Rows of (id, text): id, words, and which of them stay."""
    first = {}
    for i, t in rows:
        w = words_of(t)
        for k in range(len(w) - size + 1):
            if i is not None:
                key = tuple(w[k:k + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words_of(t)
        gone = set()
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k:k + size])] < i:
                gone |= set(range(k, k + size))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def check(df, size=R.WINDOW):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = R.remove_repeats(df, window=size).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == brute(rows, size)
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in got)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(R, "SLICE", 2_000)                     # many slices
    rng = random.Random(4)
    passages = [[rng.choice("abcdefg") * rng.randint(1, 2) for _ in range(rng.randint(10, 40))] for _ in range(8)]
    texts = []
    for _ in range(150):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += [f"w{rng.randint(0, 500)}" for _ in range(rng.randint(0, 12))]
            p = list(rng.choice(passages))
            if rng.random() < 0.4:
                p[rng.randrange(len(p))] = "edited"
            w += p[rng.randint(0, 5):]
        texts.append("\n ".join(w))
    check(docs_of(spark, texts).repartition(5))
    check(docs_of(spark, texts).repartition(3), size=5)


def test_periodic_text_and_a_passage_of_all(spark, monkeypatch):
    monkeypatch.setattr(R, "SLICE", 500)
    shared = " ".join(f"s{i}" for i in range(60))
    texts = ["la " * 200, "la " * 30, "la lo " * 40, *(f"x{i} {shared} y{i}" for i in range(80)), *[shared] * 40]
    check(docs_of(spark, texts).repartition(4))


def test_awkward_rows(spark):
    check(awkward(spark))
    assert R.remove_repeats(empty(spark)).count() == 0


def test_control_characters_and_long_words(spark):
    texts = ["a\x00b c\x1cd " * 9, "a\x00b c\x1cd " * 8 + "\x0b\x0cend", "é ü z " * 14, "é ü z " * 15,
             "x" * 3_000_000 + " " + "q " * 20, "q " * 14]
    check(docs_of(spark, texts))


def test_prefixes_are_prefix_free():
    """Equal windows have equal prefixes; a prefix needs no word behind it."""
    rng = np.random.default_rng(1)
    info = rng.integers(100, 9000, 400)
    long = R.prefix_lengths(info, np.arange(300), 13, 14 * R.UNIT)
    assert long.min() >= 1 and long.max() <= 13
    for i in range(300):
        enough = [k for k in range(1, 14) if info[i:i + k].sum() >= 14 * R.UNIT]
        assert long[i] == (enough[0] if enough else 13)


def test_deep_nodes_are_the_equal_suffixes():
    rng = np.random.default_rng(2)
    w = rng.integers(0, 3, (500, 4)).astype(np.uint64)
    codes = w.astype(np.uint8).ravel()
    h = w @ np.array([1, 7, 49, 343], np.uint64)
    order, start = R.deep_nodes(codes, h, 4)
    sizes = np.diff(np.r_[start, len(h)])
    assert sorted(sizes.tolist()) == sorted(np.unique(w, axis=0, return_counts=True)[1].tolist())
    assert (np.diff(h[order])[np.setdiff1d(np.arange(499), start - 1)] == 0).all()
