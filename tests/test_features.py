"""Hand-worked goldens (FIXTURES section 3) for scaling and encoding."""

import pytest
from pyspark.sql import functions as F

from strata.functions.vectors import argmax
from strata.operators import features as feat


def test_minmax_constant_column(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 4.0, 5.0), (4, 3.0, 5.0)],
                               "k int, x double, c double")
    out = feat.minmax_scale(df, ["x", "c"]).orderBy("k").collect()
    assert [r.x for r in out] == [0.0, 1 / 3, 1.0, 2 / 3]
    assert [r.c for r in out] == [0.0] * 4


def test_minmax_null_stays_null_and_fit_elsewhere(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "k int, x double")
    out = feat.minmax_scale(df, ["x"]).orderBy("k").collect()
    assert [r.x for r in out] == [0.0, None, 1.0]
    other = spark.createDataFrame([(9, 5.0)], "k int, x double")
    assert feat.minmax_scale(other, ["x"], fit_on=df).first().x == 2.0


def test_label_and_drop_first_dummies(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "c"), (3, "a")], "k int, s string")
    enc = feat.label_encoder_fit(df, ["s"])
    codes = enc.encode(df, ["s"]).orderBy("k").collect()
    assert [r.s for r in codes] == [1, 0, 2, 0]
    d = enc.dummies(df, ["s"]).orderBy("k")
    assert d.columns == ["k", "s_1", "s_2"]
    rows = d.collect()
    assert [r.s_1 for r in rows] == [1, 0, 0, 0]
    assert [r.s_2 for r in rows] == [0, 0, 1, 0]
    # the same projection from codes
    d2 = enc.dummies(enc.encode(df, ["s"]), ["s"], encoded=True).orderBy("k").collect()
    assert [(r.s_1, r.s_2) for r in d2] == [(r.s_1, r.s_2) for r in rows]


def test_numeric_levels_sort_numerically(spark):
    df = spark.createDataFrame([(10,), (9,), (100,)], "v int")
    assert feat.label_encoder_fit(df, ["v"]).levels["v"] == [9, 10, 100]


def test_null_category_gets_null_code_and_zero_dummies(spark):
    df = spark.createDataFrame([(0, "a"), (1, None), (2, "b")], "k int, s string")
    enc = feat.label_encoder_fit(df, ["s"])
    assert [r.s for r in enc.encode(df).orderBy("k").collect()] == [0, None, 1]
    assert [r.s_1 for r in enc.dummies(df).orderBy("k").collect()] == [0, 0, 1]


def test_one_hot_unseen_value_is_all_zero(spark):
    fit = spark.createDataFrame([("a",), ("b",), ("c",)], "y string")
    lv = feat.label_encoder_fit(fit, ["y"]).levels["y"]
    new = spark.createDataFrame([("zz",), ("b",)], "y string")
    out = feat.one_hot_label(new, "y", lv, out_col="oh").collect()
    assert out[0].oh == [0.0, 0.0, 0.0]
    assert out[1].oh == [0.0, 1.0, 0.0]


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([1.0, 5.0, 5.0],), ([3.0, 1.0, 2.0],)], "a array<double>")
    assert [r.m for r in df.select(argmax(F.col("a")).alias("m")).collect()] == [1, 0]


def test_too_many_levels_refused(spark):
    df = spark.range(100).withColumnRenamed("id", "v")
    with pytest.raises(ValueError):
        feat.label_encoder_fit(df, ["v"], max_width=10)
