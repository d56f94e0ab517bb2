"""Keys that are null or repeated must fail, levels of any type must rank, and
the neighbour search must be exact however rows are dealt."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import features as feat
from strata.operators import project as proj
from strata.operators import rank as rk
from strata.operators import knn as kn
from strata.operators import resample as rs
from strata.operators import split as spl
from strata.operators import train as tr
from strata.session import checkpoint_dir


def with_nulls(spark, n, nulls):
    return spark.range(n).select(F.col("id").alias("k")).unionByName(
        spark.range(nulls).select(F.lit(None).cast("long").alias("k")))


def test_null_keys_fail_a_split(spark):
    df = with_nulls(spark, 100, 20)
    with pytest.raises(Exception, match="null ordering key"):
        a, b = spl.train_test_split(df, "k", 0.7, 1)
        a.count()
    with pytest.raises(Exception, match="null ordering key"):
        rk.hash_rank(df, "k", 1).collect()


def test_null_keys_fail_undersampling(spark):
    df = with_nulls(spark, 100, 20).withColumn("y", F.lit(0)).unionByName(
        spark.range(1000, 1010).select(F.col("id").alias("k"), F.lit(1).alias("y")))
    with pytest.raises(Exception, match="null ordering key"):
        rs.undersample(df, "k", "y", 0.5).collect()


def test_null_labels_fail_clearly(spark):
    df = spark.createDataFrame([(1, 0), (2, None)], "k long, y int")
    with pytest.raises(ValueError, match="no label"):
        rs.undersample(df, "k", "y", 0.5)


def test_repeated_keys_fail_at_a_cut_and_in_a_rank(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("k"))
    with pytest.raises(rk.DuplicateKeyError):
        rk.cut_keys(df, "k", [705], 1)
    with pytest.raises(Exception, match="not unique"):
        rk.hash_rank(df, "k", 1).collect()


def test_two_refinement_levels_equal_the_rank(spark, monkeypatch):
    monkeypatch.setattr(rk, "FINAL_BUCKET_ROWS", 2)
    monkeypatch.setattr(rk, "BUCKET_DIGITS", 1)
    df = spark.range(700).select(F.col("id").alias("k"))
    cuts = rk.cut_keys(df, "k", [1, 350, 700], 7)
    ranked = {r["rank"]: r["k"] for r in rk.hash_rank(df, "k", 7).collect()}
    assert {t: c[1] for t, c in cuts.items()} == {t: ranked[t] for t in (1, 350, 700)}


def test_levels_of_every_type(spark):
    rows = [(1, 0.1, Decimal("10.00"), dt.date(2024, 1, 2), "b"), (2, 0.5, Decimal("9.00"), None, "a"),
            (3, 0.3, Decimal("100.00"), dt.date(2023, 1, 2), None), (4, float("nan"), None, dt.date(2024, 1, 2), "é")]
    df = spark.createDataFrame(rows, "k int, f float, d decimal(10,2), t date, s string")
    got = {r["k"]: tuple(r)[1:] for r in feat.label_encode(df, ["f", "d", "t", "s"]).collect()}
    assert got == {1: (0, 1, 1, 1), 2: (2, 0, None, 0), 3: (1, 2, 0, None), 4: (3, None, 1, 2)}
    wide = feat.get_dummies(df.select("k", "f", "d"), ["f", "d"], drop_first=True)
    assert wide.columns == ["k", "f_1", "f_2", "f_3", "d_1", "d_2"]
    assert {r["k"]: tuple(r)[1:] for r in wide.collect()} == {
        1: (0, 0, 0, 1, 0), 2: (0, 1, 0, 0, 0), 3: (1, 0, 0, 0, 1), 4: (0, 0, 1, 0, 0)}


def test_label_codes_have_no_limit(spark):
    df = spark.range(20_000).select(F.col("id"), (F.col("id") * 7 % 10_000).alias("v"))
    codes = feat.label_encode(df, ["v"]).collect()
    assert all(r["v"] == r["id"] * 7 % 10_000 for r in codes)


@pytest.mark.parametrize("cell", [3, 50, 10_000])
def test_neighbours_equal_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(kn, "LEAST_ROWS", cell)
    monkeypatch.setattr(kn, "BLOCK_ROWS", cell)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(120, 3)), 1)
    x[:40] = x[0]                                           # many rows at one place
    keys = rng.permutation(1000)[:120] - 500
    df = spark.createDataFrame([(int(k), [float(v) for v in r]) for k, r in zip(keys, x)],
                               "k long, features array<double>").repartition(5)
    got = {(r["k"], r["nbr_rank"]): r["nbr_key"] for r in rs.knn(df, "k", "features", 4).collect()}
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    for i, k in enumerate(keys):
        order = sorted((d2[i, j], keys[j]) for j in range(120) if j != i)[:4]
        assert [got[(k, n)] for n in range(4)] == [o[1] for o in order]


def test_synthetic_keys_are_new_with_negative_originals(spark):
    rng = np.random.default_rng(0)
    rows = [(int(i) - 150, [float(v) for v in rng.normal(size=2)], int(i < 20)) for i in range(220)]
    df = spark.createDataFrame(rows, "k long, features array<double>, y int")
    out = rs.smote(df, "k", "y", ratio=0.5)
    assert out.count() == out.select("k").distinct().count() == 220 + 80


def test_plan_raises_where_the_resamplers_do(spark):
    df = spark.range(400).select(F.col("id"), F.when(F.col("id") < 51, 1).otherwise(0).alias("y"))
    with pytest.raises(ValueError):
        rs.resample_plan(df, "y", 0.03, 0.3)


def test_fetch_rows_in_request_order(spark):
    df = spark.range(10).select(F.col("id").alias("pos"), (F.col("id") * 2).alias("v"))
    got = proj.fetch_rows(df, "pos", [7, 1, 7]).orderBy("request").collect()
    assert [(r["request"], r["v"]) for r in got] == [(0, 14), (1, 2), (2, 14)]


def _points(spark, n=90):
    rng = np.random.default_rng(0)
    return spark.createDataFrame(
        [(int(i), [float(v) for v in rng.normal(size=3)], int(i % 2)) for i in range(n)],
        "key long, features array<double>, label int")


def test_sync_mode_follows_shuffle_and_world_size(spark):
    df, run = _points(spark), {}
    for name, kw in (("fixed", dict(shuffle=False)), ("drawn", {}), ("three", dict(world_size=3, shuffle=False)),
                     ("seven", dict(world_size=7, shuffle=False))):
        run[name] = tr.train_mlp(df, "key", [3, 4, 2], lr=0.05, batch_size=21, epochs=1, mode="sync",
                                 seed=2, **kw).state.params[0][0]
    assert not np.allclose(run["fixed"], run["drawn"])
    assert np.allclose(run["fixed"], run["three"])          # 90 rows: no padding, the same batches
    assert not np.allclose(run["fixed"], run["seven"])      # padded to 91


def test_models_are_packed_by_bytes(spark, monkeypatch):
    df = _points(spark, 40)
    specs = [tr.ModelSpec(t, [3, 4, 2], 0.01, 8) for t in range(5)]
    out = []
    for limit in (1 << 30, 2 * 3 * 8 * 26):
        monkeypatch.setattr(tr, "MAX_MODEL_BYTES", limit)
        base = tr.shard_table(df, "key", 2, 1)
        states = {s.trial_id: tr.TrainState.fresh(s.layers, s.trial_id) for s in specs}
        out.append(tr.run_epochs(base, "key", specs, states, 1, 1))
    assert len(tr.packs(specs)) == 3
    for t in range(5):
        for (a, b), (c, d) in zip(out[0][t].params, out[1][t].params):
            assert (a == c).all() and (b == d).all()


def test_no_checkpoint_folder_raises(spark, monkeypatch):
    class Bare:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default
        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None
    from strata.session import ensure_checkpoint_dir
    for fn in (checkpoint_dir, ensure_checkpoint_dir):
        with pytest.raises(RuntimeError):
            fn(Bare())


def jobs_of(spark, run, group):
    """Spark jobs that an action takes."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_levels_of_many_columns_take_one_scan(spark):
    df = spark.range(3000).select(
        "id", (F.col("id") % 7).alias("a"), F.concat(F.lit("s"), F.col("id") * 7 % 1000).alias("b"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 11).cast("string")).alias("c"), (F.col("id") % 3 - 1.5).alias("d"))
    codes = {r["id"]: r for r in feat.label_encode(df, ["a", "b", "c", "d"]).collect()}
    rows = df.collect()
    for c in "abcd":
        level = {v: i for i, v in enumerate(sorted({r[c] for r in rows} - {None}))}
        assert all(codes[r["id"]][c] == (None if r[c] is None else level[r[c]]) for r in rows)
    levels = feat.level_tables(df, ["a", "b", "c", "d"])
    assert levels.counts == [7, 1000, 11, 3]
    jobs = [jobs_of(spark, lambda: feat.level_tables(df, cols), f"levels{len(cols)}") for cols in (["a"], ["a", "b", "c", "d"])]
    assert jobs[0] == jobs[1]


def test_large_level_tables_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(feat, "BROADCAST_LEVELS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(500).select("id", (F.col("id") * 3 % 250).alias("v"), (F.col("id") % 4).alias("w"))
        out = feat.label_encode(df, ["v", "w"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
        assert all(r["v"] == r["id"] * 3 % 250 and r["w"] == r["id"] % 4 for r in out.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_undersampling_many_classes_takes_the_jobs_of_two(spark):
    def table(classes):
        return spark.range(4000).select("id", F.when(F.col("id") < 20, 0).otherwise(1 + F.col("id") % classes).cast("int").alias("y"))
    counts = [{r["y"]: r["count"] for r in table(k).groupBy("y").count().collect()} for k in (1, 9)]
    jobs = [jobs_of(spark, lambda: rs.undersample(table(k), "id", "y", 0.3, 1, counts=c), f"under{k}")
            for k, c in zip((1, 9), counts)]
    assert jobs[0] == jobs[1]
    got = {r["y"]: r["count"] for r in rs.undersample(table(9), "id", "y", 0.3, 1).groupBy("y").count().collect()}
    assert got == {0: 20} | {y: 66 for y in range(1, 10)}
