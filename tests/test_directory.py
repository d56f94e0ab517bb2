"""Rows by position from a stored rank directory."""

import re

import pytest
from pyspark.sql import functions as F

from strata.operators.directory import RankDirectory
from strata.operators.rank import hash_rank


@pytest.fixture(scope="module")
def held(spark, tmp_path_factory):
    df = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v")).repartition(7)
    rank = {r["rank"] - 1: r["k"] for r in hash_rank(df, "k", 9).collect()}
    return RankDirectory.write(df, "k", 9, str(tmp_path_factory.mktemp("d") / "dir")), rank


def test_listed_positions(held):
    d, rank = held
    asked = [0, 19_999, 5, 5, 777]
    got = sorted(tuple(r) for r in d.fetch(asked).select("request", "pos", "k", "v").collect())
    assert got == [(i, p, rank[p], 3 * rank[p]) for i, p in enumerate(asked)] and len(d) == 20_000
    for bad in ([-1], [20_000]):
        with pytest.raises(IndexError):
            d.fetch(bad)
    assert d.fetch([]).count() == 0


def test_the_filter_reaches_the_reader(held):
    d, _ = held
    plan = d.fetch([i * 791 for i in range(25)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [__p" in plan
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "EqualTo(__b," in pushed or "In(__b" in pushed
    assert not re.search(r"PushedFilters: \[\]", plan)


def test_a_table_of_positions(spark, held):
    d, rank = held
    asked = spark.range(6000).select(F.col("id").alias("request"), (F.col("id") * 7 % 21_000).alias("pos"))
    got = {(r["request"], r["pos"]): r["k"] for r in d.fetch(asked).collect()}
    assert got == {(i, i * 7 % 21_000): rank[i * 7 % 21_000] for i in range(6000) if i * 7 % 21_000 < 20_000}


def test_repeated_and_null_keys_fail(spark, tmp_path):
    twice = spark.range(10).select((F.col("id") % 9).alias("k"))
    d = RankDirectory.write(twice, "k", 1, str(tmp_path / "a"))
    with pytest.raises(Exception, match="not unique"):
        d.fetch(list(range(10))).collect()
    with pytest.raises(Exception, match="null ordering key"):
        RankDirectory.write(spark.sql("SELECT CAST(NULL AS BIGINT) AS k"), "k", 1, str(tmp_path / "b"))


def test_empty_table(spark, tmp_path):
    d = RankDirectory.write(spark.range(0).withColumnRenamed("id", "k"), "k", 1, str(tmp_path / "e"))
    assert len(d) == 0 and d.fetch([]).count() == 0
