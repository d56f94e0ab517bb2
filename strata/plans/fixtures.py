"""Stand-in tables built from the driver's tables (see FIXTURES.md).

flag3   lineitem: 4 numeric features -> 3-class l_returnflag, no key
emb10   embeddings: 64-wide vector -> 10 classes, key vec_id
mixed2  orders JOIN customer: 2 numeric + 3 categorical -> o_orderstatus = 'F'
rare2   events: hour, day, user, props.k -> value >= 200 (rare positive)
toxic2  labels JOIN documents: n_chars -> toxic
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import table

FLAG3_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
MIXED2_NUMERIC = ["o_totalprice", "c_acctbal"]
MIXED2_CATEGORICAL = ["o_orderpriority", "c_mktsegment", "c_nationkey"]
RARE2_FEATURES = ["hour", "day", "user_id", "k"]


def flag3(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    # + 0.0 turns -0.0 into 0.0 so both engines hash the same value
    return li.select(*[(F.col(c) + F.lit(0.0)).alias(c) for c in FLAG3_FEATURES],
                     "l_returnflag")


def emb10(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("features"),
                    F.col("label").cast("int").alias("label"))


def mixed2_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders JOIN customer; the join strategy is left to Catalyst/AQE
    (customer grows with the data, so no forced broadcast)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    return o.join(c, o["o_custkey"] == c["c_custkey"])


def mixed2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, the 5 feature columns and the binary target."""
    return mixed2_raw(spark, sf_dir).select(
        "o_orderkey", *MIXED2_NUMERIC, *MIXED2_CATEGORICAL,
        (F.col("o_orderstatus") == "F").cast("int").alias("target"))


def rare2(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.hour("ts").cast("int").alias("hour"),
        F.dayofmonth("ts").cast("int").alias("day"),
        "user_id",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.col("value") >= 200).cast("int").alias("Class"))


def toxic2(spark: SparkSession, sf_dir: str) -> DataFrame:
    lb = table(spark, sf_dir, "labels")
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lb.join(d, "doc_id").select("doc_id", "n_chars", "toxic")
