"""Model kernels: SQL forward = Arrow scoring, Spark init = NumPy init, metrics goldens."""

import numpy as np

from strata.operators import metrics as met
from strata.operators import mlp
from strata.operators import model as mdl
from strata.plans import fixtures as fx
from tests.conftest import SF001


def test_init_table_equals_numpy(spark):
    layers = [5, 4, 3]
    t = mdl.init_params_df(spark, layers, 11)
    back = mdl.params_from_df(t, layers)
    ref = mlp.init_params(layers, 11)
    np.testing.assert_array_equal(mlp.flatten(back), mlp.flatten(ref))
    bound = np.sqrt(6 / 5)
    assert np.all(np.abs(ref[0][0]) <= bound) and np.all(ref[0][1] == 0)


def test_sql_forward_equals_arrow_scoring(spark):
    df = fx.emb10(spark, SF001)
    p = mlp.init_params([64, 8, 10], 1)
    a = {r.vec_id: (r.logits, r.prediction) for r in mdl.score(df, p).collect()}
    b = {r.vec_id: (r.logits, r.prediction) for r in mdl.sql_forward(df, p).collect()}
    assert a.keys() == b.keys()
    for k in a:
        np.testing.assert_allclose(a[k][0], b[k][0], atol=1e-12)
        assert a[k][1] == b[k][1]


def test_cross_entropy_expression_matches_numpy(spark):
    df = fx.emb10(spark, SF001)
    p = mlp.init_params([64, 10], 2)
    sc = mdl.with_loss(mdl.score(df, p)).join(df.select("vec_id", "features"), "vec_id") \
        .select("features", "label", "loss").toPandas()
    x = np.stack(sc.features.to_numpy())
    ref = mlp.row_losses(mlp.forward(p, x), sc.label.to_numpy())
    np.testing.assert_allclose(sc.loss.to_numpy(), ref, atol=1e-12)


def test_mean_of_batch_means(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (0, 1.0), (1, 5.0)],
                               "batch_id long, loss double")
    assert met.batch_mean_loss(df).first().loss == 3.0
    assert met.mean_loss(df).first().loss == 2.0


def test_shard_accuracy_uses_n_over_w(spark):
    df = spark.createDataFrame([(0, 1, 1), (0, 0, 1), (1, 1, 1), (1, 1, 1)],
                               "shard int, prediction int, label int")
    got = {r.shard: r.accuracy for r in met.shard_accuracy(df, 3, 2).collect()}
    assert got == {0: 1.0, 1: 2.0}  # padding counts, denominator 3 // 2


def test_metric_lines(spark):
    m = spark.createDataFrame([(0, 0.123, 0.5)], "epoch int, loss double, accuracy double")
    assert met.format_metrics(m).first().line == \
        "Epoch 0 validation: Avg loss=0.12, Accuracy=50.0%"


def test_global_accuracy_excludes_padding(spark):
    df = spark.createDataFrame([(0, 1, 1), (1, 0, 1), (2, 1, 1)], "pos long, prediction int, label int")
    assert met.global_accuracy(df, 2).first().accuracy == 0.5
