"""End-to-end jobs on the smallest tables, plus quirk regressions (Q1, Q12)."""

import pytest

from strata.operators import project as proj
from strata.operators import split as spl
from strata.plans import jobs
from strata.sources import csv as csvsrc
from strata.session import scratch_path
from tests.conftest import SF001


def test_label_never_in_features(spark):
    p = jobs.prepare_mixed2(spark, SF001)
    assert p.width == 34  # 2 numeric + 4 + 4 + 24 dummies, no target
    assert p.train.first().features.__len__() == 34
    assert set(p.train.columns) == {"o_orderkey", "features", "label"}
    assert proj.feature_columns(spark.createDataFrame([(1, 2.0, 0)], "k int, x double, y int"),
                                "y", "k") == ["x"]


def test_sharded_training_job(spark):
    res = jobs.sharded_training(spark, SF001, epochs=2)
    m = res.metrics.orderBy("epoch").collect()
    assert len(m) == 2 and all(0.0 <= r.accuracy <= 1.0 for r in m)
    assert res.reports.count() == 2


def test_imbalanced_job(spark):
    res = jobs.imbalanced_job(spark, SF001, epochs=1)
    assert res.metrics.count() == 1


def test_search_job(spark):
    res, tested = jobs.search_job(spark, SF001, num_trials=3, max_epochs=3)
    assert res.reports.count() >= 3
    rows = tested.collect()
    assert [r.shard for r in rows] == [0, 1]


def test_fetch_rows_by_position(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    ordered = spl.epoch_order(df, "k", 1, 0)
    got = proj.fetch_rows(ordered, "pos", [0, 9]).count()
    assert got == 2


def test_csv_bad_number_fails(spark):
    path = scratch_path(spark, "bad-csv")
    spark.createDataFrame([("1", "x"), ("oops", "y")], "a string, b string").coalesce(1) \
        .write.mode("overwrite").option("header", True).csv(path)
    with pytest.raises(Exception):
        csvsrc.read_csv(spark, path, "a double, b string").collect()
    ok = csvsrc.read_csv_positional(spark, path, ["a", "b"], ["string", "string"])
    assert ok.count() == 3  # header line read as data when there is no header


def test_skip_first_row(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    assert sorted(r.k for r in proj.skip_first(df, "k").collect()) == [1, 2, 3, 4]


def test_multiclass_job(spark):
    res = jobs.multiclass_job(spark, SF001, epochs=2)
    m = res.metrics.collect()
    assert len(m) == 2 and all(r.row_loss > 0 for r in m)


def test_rare2_reference_order_sizes(spark):
    from tests.conftest import SF01
    p = jobs.prepare_rare2(spark, SF01, reference_order=True, skip_first_row=True)
    n_tr, n_te = p.train.count(), p.test.count()
    assert (n_tr, n_te) == (892, 381)  # 1274 resampled rows, first skipped, [0.7, 0.3]
    syn_test = p.test.filter("event_id < 0").count()
    assert syn_test > 0  # the leak this order has: synthetic rows reach the test split
    d = jobs.prepare_rare2(spark, SF01)
    assert d.test.filter("event_id < 0").count() == 0
    assert d.test.count() == 3000


def test_package_importable_from_any_directory(tmp_path):
    """Executors import `strata` from the shipped zip, not from the working directory."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false')"
        ".getOrCreate()\n"
        "import __spark_entry__ as se\n"
        "print('rows', se.queries()['f12_score'](s, %r).count())\n" % (root, SF001))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=300)
    assert "rows 50" in out.stdout, out.stderr[-2000:]


def test_imbalanced_search_job(spark):
    res, tested = jobs.imbalanced_search_job(spark, SF001, num_trials=3, max_epochs=2)
    t = res.trials.select("num_workers").distinct().collect()
    assert [r.num_workers for r in t] == [1]
    assert res.reports.count() >= 3 and tested.count() == 2
