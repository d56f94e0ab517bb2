"""Resampling: golden sizes, error path, geometric property of SMOTE rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import knn as kn
from strata.operators import project as proj
from strata.operators import resample as rs
from strata.plans import fixtures as fx
from tests.conftest import SF001, SF01

GOLDEN = {  # sf: (minority, majority, synthetic, majority kept, total)
    SF001: (15, 985, 14, 96, 125),
    SF01: (172, 9828, 122, 980, 1274),
}


def _rare(spark, sf):
    return proj.assemble_features(fx.rare2(spark, sf), fx.RARE2_FEATURES,
                                  keep=["event_id", "Class"])


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_golden_sizes(spark, sf):
    mn, mj, syn, kept, total = GOLDEN[sf]
    df = _rare(spark, sf)
    counts = rs.class_counts(df, "Class")
    assert counts == {1: mn, 0: mj}
    assert rs.oversample_targets(counts, 0.03) == {1: syn}
    out = rs.smote_then_undersample(df, "event_id", "Class", "features", 0.03, 0.3, 42)
    got = rs.class_counts(out, "Class")
    assert got == {1: mn + syn, 0: kept} and sum(got.values()) == total


def test_target_rules():
    assert rs.undersample_targets({1: 294, 0: 9950}, 0.3) == {0: 980}
    with pytest.raises(ValueError):
        rs.undersample_targets({1: 50, 0: 60}, 0.3)


def test_smote_error_when_ratio_already_met(spark):
    df = fx.toxic2(spark, SF01).select(
        "doc_id", F.array(F.col("n_chars").cast("double")).alias("features"), "toxic")
    with pytest.raises(ValueError):
        rs.smote(df, "doc_id", "toxic", "features", 0.03, 42)


def test_smote_rows_lie_on_neighbour_segments(spark):
    df = _rare(spark, SF001)
    m = df.filter("Class = 1").select("event_id", "features")
    res = rs.smote_rows(m, "event_id", "features", 14, 42)
    syn = np.stack([np.array(r.features) for r in res.synthetic.collect()])
    pts = {r.event_id: np.array(r.features) for r in m.collect()}
    nb = {}
    for r in res.neighbours.collect():
        nb.setdefault(r.event_id, []).append(r.nbr_key)
    for s in syn:
        ok = False
        for a, lst in nb.items():
            for b in lst:
                d = pts[b] - pts[a]
                t = np.dot(s - pts[a], d) / max(np.dot(d, d), 1e-300)
                if -1e-9 <= t <= 1 + 1e-9 and np.allclose(pts[a] + t * d, s, atol=1e-7):
                    ok = True
        assert ok


def test_knn_blocks_agree(spark, monkeypatch):
    df = _rare(spark, SF01).filter("Class = 1").select("event_id", "features")
    one = sorted(map(tuple, rs.knn(df, "event_id", "features", 5).collect()))
    monkeypatch.setattr(kn, "LEAST_ROWS", 7)  # forces many blocks
    monkeypatch.setattr(kn, "BLOCK_ROWS", 7)
    many = sorted(map(tuple, rs.knn(df, "event_id", "features", 5).collect()))
    assert one == many


def test_undersample_exact_and_partition_independent(spark):
    df = _rare(spark, SF01)
    a = rs.undersample(df.repartition(5), "event_id", "Class", 0.3, 1)
    b = rs.undersample(df.coalesce(1), "event_id", "Class", 0.3, 1)
    ka = sorted(r.event_id for r in a.collect())
    assert ka == sorted(r.event_id for r in b.collect())
    assert rs.class_counts(a, "Class") == {1: 172, 0: 573}


def test_block_pairs_break_ties_by_key(monkeypatch):
    monkeypatch.setattr(kn, "SUB_ROWS", 16)
    monkeypatch.setattr(kn, "STEP_CELLS", 300)
    rng = np.random.default_rng(0)
    x = rng.integers(0, 3, size=(90, 2)).astype(float)
    key = rng.permutation(90)
    side = {"key": key, "x": x, "d": np.sqrt((x ** 2).sum(1))[:, None]}
    r, c, d2, seen = kn.block_pair({**side, "reach": np.full(90, np.inf)}, side, 5)
    full = ((x[:, None] - x[None]) ** 2).sum(2)
    for q in range(90):
        want = sorted((full[q, j], key[j]) for j in range(90) if j != q)[:5]
        assert [(a, b) for a, b in zip(d2[r == q], key[c[r == q]])] == want
    assert seen <= 90 * 90


def test_pivot_bounds_save_distances_and_groups_are_bounded(spark, monkeypatch):
    """Clustered rows: exact, and a small share of all distances is taken."""
    monkeypatch.setattr(kn, "LEAST_ROWS", 100)
    monkeypatch.setattr(kn, "BLOCK_ROWS", 100)
    monkeypatch.setattr(kn, "SUB_ROWS", 25)
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(3000, 4)) * 0.1 + rng.integers(0, 12, size=(3000, 1)) * 5.0)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k long, features array<double>").repartition(6)
    screened = spark.sparkContext.accumulator(0)
    got = kn.knn(df, "k", screened=screened).collect()
    d2 = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d2, np.inf)
    best = np.argsort(d2, axis=1, kind="stable")[:, :5]
    want = {(i, n): j for i, row in enumerate(best) for n, j in enumerate(row)}
    assert {(r["k"], r["nbr_rank"]): r["nbr_key"] for r in got} == want
    assert screened.value < 0.2 * 3000 ** 2


def test_far_from_the_origin(spark, monkeypatch):
    monkeypatch.setattr(kn, "LEAST_ROWS", 40)
    monkeypatch.setattr(kn, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(2)
    x = 1e8 + rng.normal(size=(300, 3))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k long, features array<double>")
    d2 = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d2, np.inf)
    got = {(r["k"], r["nbr_rank"]): r["nbr_key"] for r in kn.knn(df, "k").collect()}
    assert got == {(i, n): j for i, row in enumerate(np.argsort(d2, axis=1, kind="stable")[:, :5]) for n, j in enumerate(row)}


def test_smote_multiclass_targets_and_unique_keys(spark):
    rng = np.random.default_rng(3)
    rows, key = [], 0
    for cls, n in (("a", 100), ("b", 10), ("c", 20)):
        for _ in range(n):
            rows.append((key, [float(v) for v in rng.normal(size=2)], cls))
            key += 1
    df = spark.createDataFrame(rows, "k long, features array<double>, y string")
    assert rs.oversample_targets(rs.class_counts(df, "y"), 0.5) == {"b": 40, "c": 30}
    out = rs.smote(df, "k", "y", "features", 0.5, seed=1)
    assert rs.class_counts(out, "y") == {"a": 100, "b": 50, "c": 50}
    keys = [r.k for r in out.collect()]
    assert len(keys) == len(set(keys)) == 200


def test_undersample_multiclass(spark):
    rows = [(i, "a") for i in range(100)] + [(100 + i, "b") for i in range(40)] + \
           [(200 + i, "c") for i in range(9)]
    df = spark.createDataFrame(rows, "k long, y string")
    out = rs.undersample(df, "k", "y", 0.5, seed=2)
    assert rs.class_counts(out, "y") == {"a": 18, "b": 18, "c": 9}


def test_screening_distances_takes_few_arrays():
    """Rows that all lie within reach: a step holds a few arrays of ``STEP_CELLS``, whatever the block."""
    import tracemalloc
    x = np.random.default_rng(2).normal(size=(2048, 4))
    side = {"key": np.arange(2048), "x": x, "d": np.abs(x[:, :2]), "reach": np.full(2048, np.inf)}
    tracemalloc.start()
    kn.block_pair(side, side, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
