"""One worker's exact steps, each batch shared by many tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import mlp
from strata.operators import search as srch
from strata.operators import train as tr
from strata.functions.hashing import row_hash
from strata.session import scratch_path
from tests.test_train import _local_order, _separable


@pytest.fixture(autouse=True)
def many_slices(monkeypatch):
    monkeypatch.setattr(tr, "SLICE_ROWS", 4)


def plain(df, seeds, layers, lr, batch, epochs, order, drop_last=False):
    st = tr.TrainState.fresh(layers, seeds)
    p, m, v, step, losses = st.params, st.m, st.v, 0, []
    for e in range(epochs):
        x, y = order(e)
        p, m, v, step, loss, k = mlp.sgd_epoch(p, m, v, step, x, y, batch, lr, drop_last)
        losses.append(loss / k)
    return p, losses, step


def test_twenty_steps_equal_the_plain_loop(spark):
    df, layers = _separable(spark, 250), [3, 9, 5, 2]
    res = tr.train_mlp(df.repartition(5), "key", layers, lr=0.02, batch_size=24, epochs=2, mode="sync", seed=3)
    p, losses, step = plain(df, 3, layers, 0.02, 24, 2, lambda e: _local_order(df, 3, e))
    assert res.state.step == step == 22
    np.testing.assert_allclose(mlp.flatten(res.state.params), mlp.flatten(p), rtol=0, atol=1e-9)
    got = [r["training_loss"] for r in res.reports.orderBy("epoch").collect()]
    np.testing.assert_allclose(got, losses, atol=1e-9)


def fixed_order(df, seed):
    pdf = df.select("features", "label", "key", row_hash("key", seed).alias("h")).toPandas().sort_values(["h", "key"])
    return np.stack(pdf.features.to_numpy()), pdf.label.to_numpy()


def test_a_search_of_different_batches_equals_plain_loops(spark):
    """Packed trials with their own batch sizes and rates; each batch lies in several tasks."""
    df = _separable(spark, 210)
    configs = {0: (20, 4, 3, 3, 0.05), 1: (32, 6, 4, 3, 0.01), 2: (60, 5, 4, 2, 0.003)}
    trials = spark.createDataFrame([(t, c, 1) for t, c in configs.items()],
                                   "trial_id int, config struct<batch_size: int, l1: int, l2: int, l3: int, lr: double>, num_workers int")
    res = srch.run_search(df, "key", trials, in_width=3, n_classes=2, max_epochs=3, seed=7, shuffle=False, mode="sync",
                          checkpoint_path=scratch_path(spark, "spread-search"))
    rows = res.reports.collect()
    x, y = fixed_order(df, 7)
    for t, (batch, *hidden, lr) in configs.items():
        layers = [3, *hidden, 2]
        mine = sorted((r["epoch"], r["training_loss"]) for r in rows if r["trial_id"] == t)
        p, losses, _ = plain(df, f"7:{t}", layers, lr, batch, len(mine), lambda e: (x, y))
        np.testing.assert_allclose([v for _, v in mine], losses, atol=1e-9)
        state = tr.read_checkpoint(spark, res.checkpoint_path, t, layers)
        np.testing.assert_allclose(mlp.flatten(state.params), mlp.flatten(p), rtol=0, atol=1e-9)
    assert len(rows) >= 4


def test_a_batch_lies_in_many_tasks_and_parts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(tr, "PART_ROWS", 20)
    df = _separable(spark, 240)
    table = tr.spread_table(df, "key", 1, 3, None, batch_rows=32)
    where = table.rows.select("pos", F.spark_partition_id().alias("part"))
    sizes = [r["count"] for r in where.groupBy("part").count().collect()]
    first = where.where("pos < 32").select("part").distinct().count()
    table.rows.unpersist()
    assert max(sizes) <= 20 and sum(sizes) == 240
    assert first == min(8, spark.sparkContext.defaultParallelism)


def test_short_steps_share_a_job_and_large_batches_a_step(spark, monkeypatch):
    """Batches below ``SHARED_ROWS`` take a job for every ``RUN_ROWS`` rows, not one a step; same steps."""
    monkeypatch.setattr(tr, "RUN_ROWS", 100)
    monkeypatch.setattr(tr, "SHARED_ROWS", 90)
    df, sc = _separable(spark, 310), spark.sparkContext
    specs = [tr.ModelSpec(0, [3, 5, 2], 0.02, 4), tr.ModelSpec(1, [3, 4, 2], 0.01, 7, drop_last=True), tr.ModelSpec(2, [3, 6, 2], 0.05, 95)]
    states = {s.trial_id: tr.TrainState.fresh(s.layers, s.trial_id) for s in specs}
    table = tr.spread_table(df, "key", 1, 7, None, 4)
    sc.setJobGroup("spread-jobs", "steps of an epoch")
    try:
        got = tr.spread_epoch(table, specs, states)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        table.rows.unpersist()
    x, y = fixed_order(df, 7)
    for s in specs:
        st = states[s.trial_id]
        p, _, _, step, loss, k = mlp.sgd_epoch(st.params, st.m, st.v, 0, x, y, s.batch_size, s.lr, s.drop_last)
        new, mean, steps = got[s.trial_id]
        assert (new.step, steps, new.epoch) == (step, k, 1)
        np.testing.assert_allclose(mlp.flatten(new.params), mlp.flatten(p), rtol=0, atol=1e-9)
        np.testing.assert_allclose(mean, loss / k, atol=1e-9)
    # 78 and 44 short steps in 4 jobs, 4 shared ones in 4; adaptive execution runs a few jobs for each
    assert 8 <= len(sc.statusTracker().getJobIdsForGroup("spread-jobs")) < 40
