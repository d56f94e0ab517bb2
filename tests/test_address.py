"""Row numbers of tables without a key."""

import pytest
from pyspark.sql import functions as F

from strata.operators import project, split
from strata.plans import fixtures as fx
from strata.sources import address as ad
from strata.sources.csv import read_csv_positional
from tests.conftest import SF001

TYPES = ["double", "double", "string"]


@pytest.fixture
def lines(tmp_path):
    """A folder of three CSV files without header or key, many rows repeated."""
    rows = []
    for k, n in enumerate((700, 1, 1300)):
        part = [f"{i % 7}.5,{i % 3}.0,{'xyz'[i % 3]}" for i in range(n)]
        (tmp_path / f"part-{k}.csv").write_text("\n".join(part) + "\n")
        rows += part
    return str(tmp_path), [(float(a), float(b), c) for a, b, c in (r.split(",") for r in rows)]


def scan(spark, path):
    return read_csv_positional(spark, path, ["a", "b", "c"], TYPES)


@pytest.mark.parametrize("split_bytes", ["64", "1000", "100000"])
def test_csv_rows_are_numbered_in_file_order_however_it_is_cut(spark, lines, split_bytes):
    path, rows = lines
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        got = ad.numbered(scan(spark, path)).collect()
        tasks = scan(spark, path).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r["row"])] == rows
    assert [r["row"] for r in sorted(got, key=lambda r: r["row"])] == list(range(len(rows)))
    assert tasks > 20 or split_bytes != "64"


def test_parquet_rows_are_numbered_in_file_order(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") % 5).alias("v"), F.col("id").alias("truth"))
    df.repartitionByRange(4, "truth").sortWithinPartitions("truth").write.option(
        "parquet.block.size", 4096).parquet(str(tmp_path / "t"))
    got = ad.numbered(spark.read.parquet(str(tmp_path / "t")).select("truth"))
    assert got.where("row <> truth").count() == 0 and got.count() == 5000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<truth:bigint>" in plan or "truth" in plan


def test_keyless_split_is_exact_and_the_same_on_reruns(spark, lines):
    path, rows = lines
    keyed = ad.numbered(scan(spark, path))
    train, test = split.train_test_split(keyed, "row", 0.7, seed=5)
    a = sorted(r["row"] for r in train.collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        b = sorted(r["row"] for r in split.train_test_split(ad.numbered(scan(spark, path)), "row", 0.7, seed=5)[0].collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert a == b and len(a) == int(0.7 * len(rows)) and test.count() == len(rows) - len(a)


def test_skipping_batches_and_epochs_of_a_keyless_table(spark):
    keyed = ad.numbered(fx.flag3(spark, SF001))
    n = keyed.count()
    assert project.skip_first(keyed, "row", 1).agg(F.min("row")).first()[0] == 1
    batches = split.batches(keyed, "row", 50, 3, drop_last=True)
    assert {r["count"] for r in batches.groupBy("batch_id").count().collect()} == {50}
    one, two = (split.epoch_order(keyed, "row", 3, e) for e in (0, 1))
    assert one.agg(F.count_distinct("pos"), F.max("pos")).first()[:] == (n, n - 1)
    assert one.join(two, ["row", "pos"]).count() < n / 100


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_rows_of_one_file_do_not_meet_in_one_task(spark, tmp_path, kind):
    """Whatever Spark thinks of the size of the offsets, rows are not shuffled by their file."""
    path = str(tmp_path / "one")
    spark.range(2000).select(*((F.col("id") % m).cast("double").alias(c) for c, m in (("a", 5), ("b", 3))),
                             F.lit("x").alias("c")).coalesce(1).write.format(kind).save(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ad.numbered(spark.read.parquet(path) if kind == "parquet" else scan(spark, path))
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = sorted(r["row"] for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and rows == list(range(2000))


def test_what_has_no_order_is_refused(spark):
    with pytest.raises(ValueError, match="scan of files"):
        ad.numbered(spark.range(3))
    with pytest.raises(ValueError, match="column 'row'"):
        ad.numbered(spark.range(3).withColumnRenamed("id", "row"))


def test_empty_table(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    assert ad.numbered(scan(spark, str(tmp_path))).collect() == []
