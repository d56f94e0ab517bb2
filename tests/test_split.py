"""Exact splits, batches and shards: goldens and properties."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.operators import rank as rk
from strata.operators import split as spl
from tests.conftest import SF01


def test_split_sizes_rules():
    assert spl.split_sizes(15000, [0.05, 0.95]) == [750, 14250]
    assert spl.split_sizes(10, [0.33, 0.33, 0.34]) == [4, 3, 3]
    assert spl.train_size(10000, 0.7) == 7000
    with pytest.raises(ValueError):
        spl.split_sizes(10, [0.5, 0.6])


def test_events_split_golden(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet").select("event_id")
    train, test = spl.train_test_split(ev, "event_id", 0.7, 42)
    assert train.count() == 7000 and test.count() == 3000
    assert train.agg(F.sum("event_id")).first()[0] == 35074738
    assert train.join(test, "event_id").count() == 0


def test_fixture_split_sizes(spark):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id")
    a, b = spl.train_test_split(emb, "vec_id", 0.7, 42)
    assert (a.count(), b.count()) == (350, 150)
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey")
    parts = spl.random_split(o, "o_orderkey", [0.05, 0.95], 42)
    assert [p.count() for p in parts] == [750, 14250]


def test_multilevel_cut_equals_rank(spark, monkeypatch):
    """Force the bucket-refinement path and compare with the full rank."""
    monkeypatch.setattr(rk, "FINAL_BUCKET_ROWS", 3)
    monkeypatch.setattr(rk, "BUCKET_DIGITS", 1)
    df = spark.range(500).withColumnRenamed("id", "k")
    cuts = rk.cut_keys(df, "k", [1, 137, 499], 7)
    ranked = {r.rank: r.k for r in rk.hash_rank(df, "k", 7).collect()}
    for t in (1, 137, 499):
        assert cuts[t][1] == ranked[t]


@settings(max_examples=5, deadline=None)
@given(n=st.integers(5, 80), parts=st.sampled_from([1, 3, 8]))
def test_split_independent_of_partitioning(spark, n, parts):
    df = spark.range(n).withColumnRenamed("id", "k")
    a = spl.assign_split(df.repartition(parts), "k", spl.split_sizes(n, [0.6, 0.4]), 3)
    b = spl.assign_split(df.coalesce(1), "k", spl.split_sizes(n, [0.6, 0.4]), 3)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    counts = dict(a.groupBy("split").count().collect())
    assert counts.get(0, 0) == spl.split_sizes(n, [0.6, 0.4])[0]


def test_rank_is_permutation(spark):
    df = spark.range(1000).withColumnRenamed("id", "k").repartition(7)
    r = rk.hash_rank(df, "k", 1)
    got = sorted(x.rank for x in r.collect())
    assert got == list(range(1, 1001))


def test_tail_batch_drop_and_keep(spark):
    df = spark.range(7).withColumnRenamed("id", "k")
    keep = spl.batches(df, "k", 3, 0).groupBy("batch_id").count().orderBy("batch_id")
    drop = spl.batches(df, "k", 3, 0, drop_last=True).groupBy("batch_id").count() \
        .orderBy("batch_id")
    assert [r["count"] for r in keep.collect()] == [3, 3, 1]
    assert [r["count"] for r in drop.collect()] == [3, 3]


def test_pad_shards_wrap_around(spark):
    df = spark.range(7).withColumnRenamed("id", "k")
    sh = spl.shards(df, "k", 3, 0)
    sizes = [r["count"] for r in sh.groupBy("shard").count().orderBy("shard").collect()]
    assert sizes == [3, 3, 3]
    ranked = {r.k: r.rank for r in rk.hash_rank(df, "k", 0).collect()}
    dup = [r.k for r in sh.groupBy("k").count().filter("count > 1").collect()]
    assert sorted(ranked[k] for k in dup) == [1, 2]


def test_worker_batch_size():
    assert spl.worker_batch_size(30, 3) == 10
    with pytest.raises(ValueError):
        spl.worker_batch_size(1, 2)


def test_hot_duplicate_key_refused(spark, monkeypatch):
    """A key repeated for a third of the rows would put them in one task."""
    monkeypatch.setattr(rk, "BUCKET_DIGITS", 2)
    hot = spark.range(60000).select((F.when(F.col("id") % 3 == 0, F.lit(-1))
                                     .otherwise(F.col("id"))).alias("k"))
    with pytest.raises(Exception, match="not unique"):
        rk.hash_rank(hot, "k", 1).write.format("noop").mode("overwrite").save()
    ok = spark.range(60000).withColumnRenamed("id", "k")
    assert rk.hash_rank(ok, "k", 1).count() == 60000


def test_cut_search_refuses_duplicate_digest(spark, monkeypatch):
    monkeypatch.setattr(rk, "FINAL_BUCKET_ROWS", 2)
    monkeypatch.setattr(rk, "BUCKET_DIGITS", 16)
    dup = spark.range(20).select(F.lit(7).alias("k"))
    with pytest.raises(rk.DuplicateKeyError):
        rk.cut_keys(dup, "k", [5], 1)


def test_three_way_split_exact_and_disjoint(spark):
    df = spark.range(1001).withColumnRenamed("id", "k")
    parts = spl.random_split(df, "k", [0.5, 0.3, 0.2], 4)
    sizes = [p.count() for p in parts]
    assert sizes == spl.split_sizes(1001, [0.5, 0.3, 0.2]) and sum(sizes) == 1001
    keys = [set(r.k for r in p.collect()) for p in parts]
    assert not (keys[0] & keys[1]) and not (keys[1] & keys[2]) and not (keys[0] & keys[2])


def test_composite_key_split_matches_rank(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_custkey")
    n = o.count()
    tagged = spl.assign_split(o, ["o_orderkey", "o_custkey"], [6000, n - 6000], 9, n=n)
    ranked = rk.hash_rank(o, ["o_orderkey", "o_custkey"], 9)
    first = {r.o_orderkey for r in ranked.filter("rank <= 6000").collect()}
    train = {r.o_orderkey for r in tagged.filter("split = 0").collect()}
    assert train == first and len(train) == 6000
