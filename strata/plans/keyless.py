"""Registered queries over tables without a key (rows numbered by ``sources.address``).

The oracles number the rows of the same file with ``row_number() OVER ()``, the
order in which DuckDB reads it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import features as feat
from strata.operators import project as proj
from strata.operators import split as spl
from strata.plans import fixtures as fx
from strata.plans.catalog import FLAG3_SQL, SEED, _rank_sql, _scratch, query
from strata.sources import csv as csvsrc
from strata.sources.address import numbered

ROWS_SQL = f"SELECT *, row_number() OVER () - 1 AS row FROM ({FLAG3_SQL})"
_RANKED = _rank_sql(ROWS_SQL, "row", f"{SEED}:")


def keyless_csv(spark, sf_dir):
    """The 3-class table as the job meets it: CSV without header and key, read by position."""
    path = _scratch(spark, "keyless")
    rows = numbered(fx.flag3(spark, sf_dir)).repartitionByRange("row").sortWithinPartitions("row")
    csvsrc.write_csv(rows.drop("row"), path, header=False)
    return csvsrc.read_csv_positional(spark, path, fx.FLAG3_FEATURES + ["l_returnflag"], ["double"] * 4 + ["string"])


@query("e1_keyless_split", f"""
SELECT row, {', '.join(fx.FLAG3_FEATURES)}, l_returnflag,
       CAST(CASE WHEN rnk <= floor(0.7::DOUBLE * n) THEN 0 ELSE 1 END AS INTEGER) AS split
FROM ({_RANKED})""")
def e1_keyless_split(spark, sf_dir):
    """Exact 70/30 split of a Parquet table that has no key."""
    keyed = numbered(fx.flag3(spark, sf_dir))
    n = keyed.count()
    ntr = spl.train_size(n, 0.7)
    return spl.assign_split(keyed, "row", [ntr, n - ntr], SEED, n=n)


@query("e1_keyless_csv_split", f"""
SELECT row, {', '.join(f'CAST({c} AS FLOAT) AS {c}' for c in fx.FLAG3_FEATURES)},
       CAST(l_returnflag = 'A' AS DOUBLE) AS y_0, CAST(l_returnflag = 'N' AS DOUBLE) AS y_1,
       CAST(l_returnflag = 'R' AS DOUBLE) AS y_2,
       CAST(CASE WHEN rnk <= floor(0.7::DOUBLE * n) THEN 0 ELSE 1 END AS INTEGER) AS split
FROM ({_RANKED})""")
def e1_keyless_csv_split(spark, sf_dir):
    """Loading of the multi-class job: headerless CSV without a key, features cast
    to float, one-hot label, exact 70/30 split."""
    keyed = numbered(keyless_csv(spark, sf_dir))
    n = keyed.count()
    ntr = spl.train_size(n, 0.7)
    one = feat.one_hot_label(proj.cast_features(keyed, fx.FLAG3_FEATURES), "l_returnflag", out_col="y")
    wide = one.select("row", *fx.FLAG3_FEATURES, *(F.col("y")[i].cast("double").alias(f"y_{i}") for i in range(3)))
    return spl.assign_split(wide, "row", [ntr, n - ntr], SEED, n=n)


@query("b6_keyless_skip_first", f"SELECT * FROM ({ROWS_SQL}) WHERE row >= 1")
def b6_keyless_skip_first(spark, sf_dir):
    """All rows but the first of the file."""
    return proj.skip_first(numbered(fx.flag3(spark, sf_dir)), "row", 1)


@query("e3_keyless_epoch_order", f"""
SELECT row, CAST(epoch AS INTEGER) AS epoch,
       row_number() OVER (PARTITION BY epoch ORDER BY md5('{SEED}:' || epoch || ':' || row), row) - 1 AS pos
FROM (SELECT row FROM ({ROWS_SQL})) CROSS JOIN range(0, 2) t(epoch)""")
def e3_keyless_epoch_order(spark, sf_dir):
    """Two epochs' orders of a table without a key."""
    keyed = numbered(fx.flag3(spark, sf_dir)).select("row")
    one, two = (spl.epoch_order(keyed, "row", SEED, e).withColumn("epoch", F.lit(e)) for e in range(2))
    return one.unionByName(two).select("row", "epoch", "pos")


@query("e4_keyless_batches", f"""
SELECT row, (rnk - 1) // 5 AS batch_id FROM ({_RANKED}) WHERE (rnk - 1) // 5 < n // 5""")
def e4_keyless_batches(spark, sf_dir):
    """Batches of 5 rows, the short tail dropped, of a table without a key."""
    return spl.batches(numbered(fx.flag3(spark, sf_dir)).select("row"), "row", 5, SEED, drop_last=True)
