import numpy as np
import pytest

from strata.functions.hashing import row_hash
from strata.operators import mlp
from strata.operators import train as tr


def _separable(spark, n=240):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(int)
    rows = [(int(i), [float(v) for v in x[i]], int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "key long, features array<double>, label int")


def _local_order(df, seed, epoch):
    pdf = df.select("key", "features", "label", row_hash("key", seed, epoch).alias("h")) \
        .toPandas().sort_values(["h", "key"])
    return np.stack(pdf.features.to_numpy()), pdf.label.to_numpy()


def test_single_worker_local_equals_numpy_loop(spark):
    df = _separable(spark)
    layers = [3, 8, 2]
    res = tr.train_mlp(df, "key", layers, lr=0.01, batch_size=7, epochs=2, world_size=1,
                       seed=5)
    st = tr.TrainState.fresh(layers, 5)
    p, m, v, step = st.params, st.m, st.v, 0
    for ep in range(2):
        x, y = _local_order(df, 5, ep)
        p, m, v, step, _, _ = mlp.sgd_epoch(p, m, v, step, x, y, 7, 0.01)
    assert res.state.step == step
    np.testing.assert_allclose(mlp.flatten(res.state.params), mlp.flatten(p), rtol=0, atol=1e-12)


def test_sync_full_batch_equals_one_process(spark):
    df = _separable(spark, 60)
    layers = [3, 4, 2]
    res = tr.train_mlp(df, "key", layers, lr=0.05, batch_size=60, epochs=3, mode="sync",
                       seed=1)
    st = tr.TrainState.fresh(layers, 1)
    x, y = _local_order(df, 1, 0)
    p, m, v, step = st.params, st.m, st.v, 0
    for _ in range(3):
        p, m, v, step, _, _ = mlp.sgd_epoch(p, m, v, step, x, y, 60, 0.05)
    np.testing.assert_allclose(mlp.flatten(res.state.params), mlp.flatten(p), atol=1e-12)


def test_resume_equals_uninterrupted(spark):
    df = _separable(spark, 120)
    layers = [3, 5, 2]
    full = tr.train_mlp(df, "key", layers, lr=0.02, batch_size=10, epochs=3, world_size=2,
                        seed=9)
    half = tr.train_mlp(df, "key", layers, lr=0.02, batch_size=10, epochs=1, world_size=2,
                        seed=9)
    rest = tr.train_mlp(df, "key", layers, lr=0.02, batch_size=10, epochs=2, world_size=2,
                        seed=9, init=half.state)
    np.testing.assert_allclose(mlp.flatten(rest.state.params), mlp.flatten(full.state.params),
                               atol=1e-12)
    assert rest.state.epoch == 3


def test_loss_falls_on_separable_data(spark):
    df = _separable(spark, 400)
    res = tr.train_mlp(df, "key", [3, 16, 2], lr=0.01, batch_size=20, epochs=6, world_size=3,
                       seed=2, eval_df=df)
    rep = res.reports.orderBy("epoch").toPandas()
    assert rep.training_loss.iloc[-1] < rep.training_loss.iloc[0]
    acc = res.metrics.orderBy("epoch").toPandas().accuracy
    assert acc.iloc[-1] > 0.85


def test_gradient_matches_finite_difference(spark):
    df = _separable(spark, 50)
    layers = [3, 4, 2]
    p = mlp.init_params(layers, 3)
    g = tr.gradient(df, p).toPandas()
    pdf = df.toPandas()
    x, y = np.stack(pdf.features.to_numpy()), pdf.label.to_numpy()
    vec = mlp.flatten(p)
    lay, ii, jj = mlp.param_index(layers)
    lookup = {(a, b, c): r for a, b, c, r in zip(g.layer, g.i, g.j, g.grad)}
    eps = 1e-6
    for pos in [0, 5, 13, len(vec) - 1]:
        d = np.zeros_like(vec)
        d[pos] = eps
        lp = mlp.row_losses(mlp.forward(mlp.unflatten(vec + d, layers), x), y).mean()
        lm = mlp.row_losses(mlp.forward(mlp.unflatten(vec - d, layers), x), y).mean()
        assert abs((lp - lm) / (2 * eps) - lookup[(lay[pos], ii[pos], jj[pos])]) < 1e-6


def test_checkpoint_roundtrip_and_strict_load(spark, tmp_path):
    layers = [3, 4, 2]
    st = tr.TrainState.fresh(layers, 4)
    st.step, st.epoch = 7, 2
    path = str(tmp_path / "ckpt")
    tr.write_checkpoint(spark, path, 3, st)
    back = tr.read_checkpoint(spark, path, 3, layers)
    assert back.step == 7 and back.epoch == 2
    np.testing.assert_array_equal(mlp.flatten(back.params), mlp.flatten(st.params))
    with pytest.raises(ValueError):
        tr.read_checkpoint(spark, path, 3, [3, 5, 2])
    with pytest.raises(FileNotFoundError):
        tr.read_checkpoint(spark, path, 99, layers)


def test_fixed_order_drop_last_equals_numpy_loop(spark):
    """shuffle=False keeps the hash order of the split every epoch; the tail is dropped."""
    from strata.operators.rank import hash_rank
    df = _separable(spark, 53)
    layers = [3, 4, 2]
    res = tr.train_mlp(df, "key", layers, lr=0.01, batch_size=5, epochs=2, world_size=1,
                       seed=8, shuffle=False, drop_last=True)
    pdf = hash_rank(df, "key", 8).toPandas().sort_values("rank")
    x, y = np.stack(pdf.features.to_numpy()), pdf.label.to_numpy()
    st = tr.TrainState.fresh(layers, 8)
    p, m, v, step = st.params, st.m, st.v, 0
    for _ in range(2):
        p, m, v, step, _, _ = mlp.sgd_epoch(p, m, v, step, x, y, 5, 0.01, drop_last=True)
    assert step == 20
    np.testing.assert_allclose(mlp.flatten(res.state.params), mlp.flatten(p), atol=1e-12)


def test_local_mode_independent_of_input_partitioning(spark):
    df = _separable(spark, 150)
    kw = dict(lr=0.02, batch_size=12, epochs=2, world_size=4, seed=6)
    a = tr.train_mlp(df.repartition(7), "key", [3, 5, 2], **kw)
    b = tr.train_mlp(df.coalesce(1), "key", [3, 5, 2], **kw)
    np.testing.assert_array_equal(mlp.flatten(a.state.params), mlp.flatten(b.state.params))


def test_eval_metrics_match_direct_scoring(spark):
    from strata.operators.model import score
    df = _separable(spark, 90)
    res = tr.train_mlp(df, "key", [3, 6, 2], lr=0.02, batch_size=10, epochs=1, world_size=2,
                       seed=3, eval_df=df)
    m = res.metrics.first()
    sc = score(df, res.state.params).toPandas()
    assert abs(m.accuracy - (sc.prediction == sc.label).mean()) < 1e-12
