import numpy as np
import pytest

from strata.llm import whitening as W


@pytest.fixture(autouse=True)
def few_blocks(monkeypatch):
    monkeypatch.setattr(W, "MIN_BLOCKS", 12)


SCHEMA = "vec_id long, embedding array<float>, label int, key string, x int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "k", 1) for i, v in enumerate(vectors)], SCHEMA)


def brute(vectors, components=16, count=False):
    """Whitened rows by plain NumPy over the whole list."""
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors]
    fit, times = np.unique(np.array(x), axis=0, return_counts=True)
    w = times if count else np.ones(len(fit), int)
    n, s = int(w.sum()), (fit * w[:, None]).sum(0)
    y = (fit * n - s) / n
    v = (y * w[:, None]).T @ y / n
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e)[:components]
    order = [k for k in order if e[k] > 1e-12 * e.max()]
    dev = [sum((n * a - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    return n, dev, (np.array(x) - s / n) @ u[:, order] / np.sqrt(e[order]), e[order] / np.trace(v)


def check(spark, df, vectors, **how):
    n, dev, white, share = brute(vectors, count=how.get("weights") == "count")
    got = W.whiten(df, **how).toPandas().sort_values(["vec_id", "component"])
    k = white.shape[1]
    assert len(got) == len(vectors) * k and set(got.n) == {n}
    assert got.deviation[got.component == 1].tolist() == dev
    z = got.whitened.to_numpy().reshape(-1, k)
    sign = np.sign((z * white).sum(0))
    assert np.allclose(z * sign, white, atol=1e-6)
    assert np.allclose(got.explained.to_numpy().reshape(-1, k), share, rtol=1e-8)
    assert set(got.identity_error.round(6)) == {0.0}


@pytest.mark.parametrize("weights", ["one", "count"])
def test_against_numpy(spark, weights):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(400, 20)) @ rng.normal(size=(20, 20))
    v = np.concatenate([v, v[:1].repeat(300, 0), v[5:25]]).astype(np.float32).tolist()   # one hot vector
    check(spark, table(spark, v).repartition(6), v, weights=weights)


def test_reruns_agree_bit_for_bit(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(300, 8)).astype(np.float32).tolist()
    a, b = (W.whiten(table(spark, v).repartition(k)).toPandas().sort_values(["vec_id", "component"]) for k in (2, 7))
    assert (a.whitened.to_numpy() == b.whitened.to_numpy()).all()
    assert a.identity_error.iloc[0] == b.identity_error.iloc[0]


def test_awkward_rows(spark):
    good = [[1.0, 2.0], [0.5, -3.0], [4.0, 4.5], [1.0, 2.0]]
    rows = [(i, v) for i, v in enumerate(good)] + [
        (10, None), (11, []), (12, [None, 1.0]), (13, [float("nan"), 1.0]), (14, [float("inf"), 0.0]),
        (15, [1.0]), (16, [1.0, 2.0, 3.0]), (17, [1e30, 0.0]), (None, [0.5, -3.0]), (2, [4.0, 4.5])]
    df = spark.createDataFrame([(i, v, 0, "k", 1) for i, v in rows], SCHEMA)
    got = W.whiten(df)
    assert sorted((r["vec_id"] for r in got.where("component = 1").collect()), key=str) == sorted([0, 1, 2, 2, 3, None], key=str)
    n, dev, white, _ = brute(good[:3])
    assert {r["vec_id"]: r["deviation"] for r in got.collect() if r["vec_id"] in (0, 1)} == {0: dev[0], 1: dev[1]}
    assert set(r["n"] for r in got.collect()) == {3}


def test_tables_without_spread(spark):
    assert W.whiten(table(spark, [])).collect() == []
    assert W.whiten(table(spark, [[1.0, 2.0]] * 5)).collect() == []
    flat = W.whiten(table(spark, [[1.0, 2.0], [3.0, 2.0], [7.0, 2.0]])).toPandas()
    assert set(flat.component) == {1} and np.allclose(flat.explained, 1)


def test_large_numbers(spark):
    v = [[1e9, 3.0], [-1e9, 4.0], [2e9, -7.0]]
    got = W.whiten(table(spark, v)).toPandas()
    assert got.deviation.isna().all() and (got.identity_error < 1e-4).all()
