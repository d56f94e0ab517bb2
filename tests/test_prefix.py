"""Quantiles of all earlier values, block by block."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import prefix as px


def brute(rows, q):
    seen, out = [], {}
    for o, v in sorted(rows):
        out[o] = float(np.percentile(seen, 100 * q)) if seen else None
        if v is not None:
            seen.append(v)
    return out


@pytest.mark.parametrize("q", [0.5, 0.25, 2 / 3])
@pytest.mark.parametrize("kind", ["spread", "ties", "rising", "falling", "hot"])
def test_against_brute_force(spark, monkeypatch, kind, q):
    monkeypatch.setattr(px, "BLOCK", 40)
    rng = np.random.default_rng(5)
    n = 700
    v = {"spread": rng.normal(size=n), "ties": rng.integers(0, 9, n) / 2, "rising": np.arange(n) / 3,
         "falling": -np.arange(n) / 7, "hot": np.where(rng.random(n) < 0.5, 1.5, rng.normal(size=n))}[kind]
    order = rng.permutation(n * 3)[:n]
    rows = [(int(o), None if kind == "ties" and i % 50 == 0 else float(x)) for i, (o, x) in enumerate(zip(order, v))]
    df = spark.createDataFrame([(o, x, f"p{o}") for o, x in rows], "o long, v double, extra string").repartition(4)
    got = px.prefix_quantile(df, "o", "v", q).collect()
    want = brute(rows, q)
    assert {r["extra"] for r in got} == {f"p{o}" for o, _ in rows}
    assert {r["o"]: r["quantile"] is None for r in got} == {o: w is None for o, w in want.items()}
    assert all(abs(r["quantile"] - want[r["o"]]) < 1e-9 for r in got if r["quantile"] is not None)


def test_order_statistics_of_a_range_and_new_values():
    rng = np.random.default_rng(1)
    old = np.sort(rng.integers(0, 50, 200)).astype(float)
    m = px.Merged(old[60:140], 60)
    seen = list(old)
    for _ in range(30):
        x = float(rng.integers(0, 50))
        m.add(x)
        seen.append(x)
        for k in (95, 100, 110):
            assert m.kth(k) == sorted(seen)[k]


def test_a_small_and_an_empty_table(spark):
    df = spark.range(5).select(F.col("id").alias("o"), F.col("id").cast("double").alias("v"))
    got = {r["o"]: r["quantile"] for r in px.prefix_quantile(df, "o", "v", 0.5).collect()}
    assert got == {0: None, 1: 0.0, 2: 0.5, 3: 1.0, 4: 1.5}
    assert px.prefix_quantile(df.where("o < 0"), "o", "v", 0.5).collect() == []
