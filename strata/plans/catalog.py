"""Registered queries and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables.  Every computed column is aliased identically on both sides.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.vectors import argmax
from strata.operators import features as feat
from strata.operators import metrics as met
from strata.operators import mlp
from strata.operators import model as mdl
from strata.operators import project as proj
from strata.operators import resample as rs
from strata.operators import search as srch
from strata.operators import split as spl
from strata.operators import train as tr
from strata.operators.directory import RankDirectory
from strata.operators.rank import hash_rank
from strata.plans import fixtures as fx
from strata.sources import csv as csvsrc
from strata.sources import reports as repsrc
from strata.sources.tables import table

SEED = 42

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ------------------------------------------------------------ shared SQL

RARE2_SQL = """
    SELECT event_id,
           CAST(hour(ts) AS INTEGER) AS hour,
           CAST(day(ts) AS INTEGER) AS day,
           user_id,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           CAST(value >= 200 AS INTEGER) AS Class
    FROM events"""

MIXED2_SQL = """
    SELECT o_orderkey, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment, c_nationkey,
           CAST(o_orderstatus = 'F' AS INTEGER) AS target
    FROM orders JOIN customer ON o_custkey = c_custkey"""

FLAG3_SQL = """
    SELECT l_quantity + 0.0 AS l_quantity, l_extendedprice + 0.0 AS l_extendedprice,
           l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax, l_returnflag
    FROM lineitem"""


def _rank_sql(table_sql: str, key: str, prefix: str) -> str:
    return (f"SELECT *, row_number() OVER (ORDER BY md5('{prefix}' || {key}), {key}) AS rnk, "
            f"count(*) OVER () AS n FROM ({table_sql})")


# ------------------------------------------------------------ B: projection

@query("b1_drop_columns", """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority,
       c_custkey, c_nationkey, c_acctbal, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey""")
def b1_drop_columns(spark, sf_dir):
    df = fx.mixed2_raw(spark, sf_dir)
    return proj.drop_columns(df, ["o_custkey", "o_orderdate", "c_name"])


@query("b2_select_except_label", f"""
SELECT event_id, hour, day, user_id, k FROM ({RARE2_SQL})""")
def b2_select_except_label(spark, sf_dir):
    return proj.select_except(fx.rare2(spark, sf_dir), "Class")


@query("b5_label_by_name", f"""
SELECT Class FROM ({RARE2_SQL})""")
def b5_label_by_name(spark, sf_dir):
    """The label column picked by name."""
    r = fx.rare2(spark, sf_dir)
    return r.select(proj.label_column(r, "Class"))


@query("b6_skip_first", """
SELECT event_id, user_id, value FROM events
WHERE event_id > (SELECT min(event_id) FROM events)""")
def b6_skip_first(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return proj.skip_first(ev, "event_id", 1)


@query("b11_assemble_features", f"""
SELECT event_id, CAST(i AS INTEGER) AS idx, v AS value
FROM (SELECT event_id,
             unnest(range(0, 4)) AS i,
             unnest([CAST(hour AS DOUBLE), CAST(day AS DOUBLE),
                     CAST(user_id AS DOUBLE), CAST(k AS DOUBLE)]) AS v
      FROM ({RARE2_SQL}))""")
def b11_assemble_features(spark, sf_dir):
    df = proj.assemble_features(fx.rare2(spark, sf_dir), fx.RARE2_FEATURES, keep=["event_id"])
    return df.select("event_id", F.posexplode("features").alias("idx", "value")) \
        .withColumn("idx", F.col("idx").cast("int"))


# ------------------------------------------------------------ C: features

@query("c1_minmax_fit", f"""
SELECT min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity,
       min(l_extendedprice) AS min_l_extendedprice, max(l_extendedprice) AS max_l_extendedprice,
       min(l_discount) AS min_l_discount, max(l_discount) AS max_l_discount,
       min(l_tax) AS min_l_tax, max(l_tax) AS max_l_tax
FROM ({FLAG3_SQL})""")
def c1_minmax_fit(spark, sf_dir):
    return feat.minmax_stats(fx.flag3(spark, sf_dir), fx.FLAG3_FEATURES)


@query("c2_minmax_apply", f"""
SELECT (l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ()) AS l_quantity,
       (l_extendedprice - min(l_extendedprice) OVER ()) / (max(l_extendedprice) OVER () - min(l_extendedprice) OVER ()) AS l_extendedprice,
       (l_discount - min(l_discount) OVER ()) / (max(l_discount) OVER () - min(l_discount) OVER ()) AS l_discount,
       (l_tax - min(l_tax) OVER ()) / (max(l_tax) OVER () - min(l_tax) OVER ()) AS l_tax,
       l_returnflag
FROM ({FLAG3_SQL})""")
def c2_minmax_apply(spark, sf_dir):
    return feat.minmax_scale(fx.flag3(spark, sf_dir), fx.FLAG3_FEATURES)


@query("c3_label_encode", f"""
SELECT o_orderkey,
       CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority,
       CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS c_mktsegment,
       CAST(dense_rank() OVER (ORDER BY c_nationkey) - 1 AS INTEGER) AS c_nationkey
FROM ({MIXED2_SQL})""")
def c3_label_encode(spark, sf_dir):
    df = fx.mixed2(spark, sf_dir).select("o_orderkey", *fx.MIXED2_CATEGORICAL)
    return feat.label_encode(df, fx.MIXED2_CATEGORICAL)


def _dummy_sql() -> str:
    cols = []
    for c, k in (("o_orderpriority", 5), ("c_mktsegment", 5), ("c_nationkey", 25)):
        cols += [f"CAST(code_{c} = {j} AS INTEGER) AS {c}_{j}" for j in range(1, k)]
    return f"""
SELECT o_orderkey, o_totalprice, c_acctbal, target, {', '.join(cols)}
FROM (SELECT *,
             dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS code_o_orderpriority,
             dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code_c_mktsegment,
             dense_rank() OVER (ORDER BY c_nationkey) - 1 AS code_c_nationkey
      FROM ({MIXED2_SQL}))"""


@query("c4_dummies_drop_first", _dummy_sql())
def c4_dummies_drop_first(spark, sf_dir):
    return feat.get_dummies(fx.mixed2(spark, sf_dir), fx.MIXED2_CATEGORICAL, drop_first=True)


@query("c5_one_hot_label", """
SELECT e.vec_id, CAST(l.idx AS INTEGER) AS idx,
       CAST(CASE WHEN e.label = l.label THEN 1.0 ELSE 0.0 END AS DOUBLE) AS value
FROM embeddings e
CROSS JOIN (SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx
            FROM (SELECT DISTINCT label FROM embeddings)) l""")
def c5_one_hot_label(spark, sf_dir):
    df = fx.emb10(spark, sf_dir)
    enc = feat.one_hot_label(df, "label", out_col="onehot")
    return enc.select("vec_id", F.posexplode("onehot").alias("idx", "value")) \
        .withColumn("idx", F.col("idx").cast("int"))


@query("c6_argmax", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax
FROM embeddings""")
def c6_argmax(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", argmax(F.col("embedding")).alias("argmax"))


# ------------------------------------------------------------ E: order, split, batch

@query("e0_hash_rank", f"""
SELECT event_id, rnk AS rank FROM ({_rank_sql('SELECT event_id FROM events', 'event_id', '42:')})""")
def e0_hash_rank(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id")
    return hash_rank(ev, "event_id", SEED)


@query("e1_train_test_split", f"""
SELECT event_id, CAST(CASE WHEN rnk <= floor(0.7::DOUBLE * n) THEN 0 ELSE 1 END AS INTEGER) AS split
FROM ({_rank_sql('SELECT event_id FROM events', 'event_id', '42:')})""")
def e1_train_test_split(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id")
    n = ev.count()
    ntr = spl.train_size(n, 0.7)
    return spl.assign_split(ev, "event_id", [ntr, n - ntr], SEED, n=n)


@query("e2_random_split", f"""
SELECT o_orderkey, CAST(CASE WHEN rnk <= s0 THEN 0 ELSE 1 END AS INTEGER) AS split
FROM (SELECT *, floor(0.05::DOUBLE * n) + CASE WHEN n - floor(0.05::DOUBLE * n)
                  - floor(0.95::DOUBLE * n) >= 1 THEN 1 ELSE 0 END AS s0
      FROM ({_rank_sql('SELECT o_orderkey FROM orders', 'o_orderkey', '42:')}))""")
def e2_random_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    n = o.count()
    return spl.assign_split(o, "o_orderkey", spl.split_sizes(n, [0.05, 0.95]), SEED, n=n)


@query("e3_epoch_order", f"""
SELECT vec_id, CAST(epoch AS INTEGER) AS epoch,
       row_number() OVER (PARTITION BY epoch ORDER BY md5('42:' || epoch || ':' || vec_id), vec_id) - 1 AS pos
FROM embeddings CROSS JOIN range(0, 3) t(epoch)""")
def e3_epoch_order(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id")
    parts = [spl.epoch_order(e, "vec_id", SEED, ep).withColumn("epoch", F.lit(ep))
             for ep in range(3)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("vec_id", "epoch", "pos")


@query("e4_batches_drop_last", f"""
SELECT event_id, (rnk - 1) // 32 AS batch_id
FROM ({_rank_sql('SELECT event_id FROM events', 'event_id', '42:')})
WHERE (rnk - 1) // 32 < n // 32""")
def e4_batches_drop_last(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id")
    return spl.batches(ev, "event_id", 32, SEED, drop_last=True)


@query("e5_batches_keep_last", f"""
SELECT event_id, (rnk - 1) // 32 AS batch_id
FROM ({_rank_sql('SELECT event_id FROM events', 'event_id', '42:')})""")
def e5_batches_keep_last(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id")
    return spl.batches(ev, "event_id", 32, SEED, drop_last=False)


_SHARD_SQL = f"""
WITH r AS ({_rank_sql('SELECT event_id FROM events', 'event_id', '42:')}),
p AS (SELECT event_id, rnk - 1 AS pos FROM r
      UNION ALL
      SELECT event_id, rnk - 1 + n AS pos FROM r WHERE rnk <= (3 - n % 3) % 3)
SELECT event_id, pos, CAST(pos % 3 AS INTEGER) AS shard, pos // 3 AS local_pos,
       (pos // 3) // 10 AS batch_id
FROM p"""


@query("e6_shards_padded", _SHARD_SQL)
def e6_shards_padded(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id")
    sh = spl.shards(ev, "event_id", 3, SEED, pad=True)
    return spl.shard_batches(sh, spl.worker_batch_size(30, 3))


@query("e8_shard_stats", f"""
SELECT shard, count(*) AS rows, max(batch_id) + 1 AS batches
FROM ({_SHARD_SQL}) GROUP BY shard""")
def e8_shard_stats(spark, sf_dir):
    return spl.shard_stats(e6_shards_padded(spark, sf_dir))


# ------------------------------------------------------------ F/G: model, loss, metrics


EMB_LAYERS = [64, 16, 10]


def _dlit(v: float) -> str:
    return f"'{float(v)!r}'::DOUBLE"


def _mlp_sql(layers, seed, x_sql: str, key: str) -> str:
    """Relational forward pass: x_sql yields (key, j, x); returns CTE text
    ending in ``z(key, idx, logit)``.  Biases are zero (fresh init)."""
    n = len(layers) - 1
    ctes = [f"h0 AS ({x_sql})"]
    for lay in range(n):
        fi, fo = layers[lay], layers[lay + 1]
        b = mlp.layer_bound(lay, n, fi, fo)
        ctes.append(
            f"w{lay} AS (SELECT i, j, {_dlit(b)} * (2 * (('0x' || substr(md5('{seed}:{lay}:' || i"
            f" || ':' || j), 1, 8))::BIGINT / {_dlit(4294967296.0)}) - 1) AS w "
            f"FROM range(0, {fo}) a(i), range(0, {fi}) b(j))")
        agg = f"sum(h{lay}.x * w{lay}.w)"
        val = f"greatest({agg}, 0)" if lay < n - 1 else agg
        name = f"h{lay + 1}" if lay < n - 1 else "z"
        col = "x" if lay < n - 1 else "logit"
        jn = "j" if lay < n - 1 else "idx"
        ctes.append(f"{name} AS (SELECT h{lay}.{key}, w{lay}.i AS {jn}, {val} AS {col} "
                    f"FROM h{lay} JOIN w{lay} ON h{lay}.j = w{lay}.j GROUP BY h{lay}.{key}, w{lay}.i)")
    return "WITH " + ",\n".join(ctes)


EMB_X_SQL = ("SELECT vec_id, unnest(range(0, len(embedding))) AS j, "
             "unnest(embedding)::DOUBLE AS x FROM embeddings")

_EMB_SCORE_SQL = _mlp_sql(EMB_LAYERS, SEED, EMB_X_SQL, "vec_id") + """,
lse AS (SELECT vec_id, ln(sum(exp(logit - m))) + m AS lse
        FROM (SELECT vec_id, logit, max(logit) OVER (PARTITION BY vec_id) AS m FROM z)
        GROUP BY vec_id, m),
pred AS (SELECT vec_id, idx AS prediction FROM
         (SELECT vec_id, idx, row_number() OVER (PARTITION BY vec_id ORDER BY logit DESC, idx) AS r
          FROM z) WHERE r = 1),
scored AS (SELECT e.vec_id, e.label, CAST(p.prediction AS INTEGER) AS prediction,
                  l.lse - zl.logit AS loss
           FROM embeddings e JOIN pred p ON e.vec_id = p.vec_id
           JOIN lse l ON e.vec_id = l.vec_id
           JOIN z zl ON zl.vec_id = e.vec_id AND zl.idx = e.label),
ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || vec_id), vec_id) AS rnk,
                  count(*) OVER () AS n FROM scored),
test AS (SELECT * FROM ranked WHERE rnk > floor(0.7::DOUBLE * n)),
test_ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || vec_id), vec_id) AS trnk,
                       count(*) OVER () AS tn FROM test)"""


def _scored(df, seed=SEED):
    return mdl.with_loss(mdl.score(df, mlp.init_params(EMB_LAYERS, seed)))


def _emb_scored(spark, sf_dir, seed=SEED):
    return _scored(fx.emb10(spark, sf_dir), seed)


def _emb_split(spark, sf_dir):
    """Train and test rows, not yet scored: the model runs over the part needed only."""
    return spl.train_test_split(fx.emb10(spark, sf_dir), "vec_id", 0.7, SEED)


def _emb_test(spark, sf_dir):
    return _scored(_emb_split(spark, sf_dir)[1])


@query("f4_forward_logits", _mlp_sql(EMB_LAYERS, SEED, EMB_X_SQL, "vec_id") + """
SELECT vec_id, CAST(idx AS INTEGER) AS idx, round(logit, 6) AS logit FROM z""")
def f4_forward_logits(spark, sf_dir):
    sc = mdl.score(fx.emb10(spark, sf_dir), mlp.init_params(EMB_LAYERS, SEED), keep=["vec_id"])
    return sc.select("vec_id", F.posexplode("logits").alias("idx", "logit")).select(
        "vec_id", F.col("idx").cast("int").alias("idx"), F.round("logit", 6).alias("logit"))


@query("f2_f3_sql_forward", _mlp_sql(EMB_LAYERS, SEED, EMB_X_SQL, "vec_id") + """
SELECT vec_id, CAST(idx AS INTEGER) AS idx, round(logit, 6) AS logit FROM z""")
def f2_f3_sql_forward(spark, sf_dir):
    """The same forward pass as Catalyst expressions (zip_with/aggregate)."""
    sc = mdl.sql_forward(fx.emb10(spark, sf_dir), mlp.init_params(EMB_LAYERS, SEED))
    return sc.select("vec_id", F.posexplode("logits").alias("idx", "logit")).select(
        "vec_id", F.col("idx").cast("int").alias("idx"), F.round("logit", 6).alias("logit"))


@query("f5_row_loss", _EMB_SCORE_SQL + """
SELECT vec_id, round(loss, 6) AS loss FROM scored""")
def f5_row_loss(spark, sf_dir):
    return _emb_scored(spark, sf_dir).select("vec_id", F.round("loss", 6).alias("loss"))


@query("f12_score", _EMB_SCORE_SQL + """
SELECT vec_id, label, prediction FROM scored""")
def f12_score(spark, sf_dir):
    return _emb_scored(spark, sf_dir).select("vec_id", "label", "prediction")


@query("g1_mean_loss", _EMB_SCORE_SQL + """
SELECT round(avg(loss), 6) AS loss FROM test""")
def g1_mean_loss(spark, sf_dir):
    return met.mean_loss(_emb_test(spark, sf_dir)).select(F.round("loss", 6).alias("loss"))


@query("g2_accuracy", _EMB_SCORE_SQL + """
SELECT round(avg(CAST(prediction = label AS DOUBLE)), 9) AS accuracy FROM test""")
def g2_accuracy(spark, sf_dir):
    return met.accuracy(_emb_test(spark, sf_dir)).select(F.round("accuracy", 9).alias("accuracy"))


@query("g3_batch_mean_loss", _EMB_SCORE_SQL + """
SELECT round(avg(bl), 6) AS loss FROM
  (SELECT (trnk - 1) // 32 AS b, avg(loss) AS bl FROM test_ranked GROUP BY b)""")
def g3_batch_mean_loss(spark, sf_dir):
    tb = spl.batches(_emb_split(spark, sf_dir)[1], "vec_id", 32, SEED)
    scored = mdl.with_loss(mdl.score(tb, mlp.init_params(EMB_LAYERS, SEED)))
    return met.batch_mean_loss(scored).select(F.round("loss", 6).alias("loss"))


@query("g4_shard_accuracy", _EMB_SCORE_SQL + """,
padded AS (SELECT label, prediction, trnk - 1 AS pos FROM test_ranked
           UNION ALL
           SELECT label, prediction, trnk - 1 + tn AS pos FROM test_ranked
           WHERE trnk <= (3 - tn % 3) % 3)
SELECT CAST(pos % 3 AS INTEGER) AS shard,
       CAST(sum(CAST(prediction = label AS BIGINT)) AS BIGINT) AS correct,
       count(*) AS rows,
       round(sum(CAST(prediction = label AS BIGINT)) / CAST((SELECT count(*) FROM test) // 3 AS DOUBLE), 9) AS accuracy
FROM padded GROUP BY shard""")
def g4_shard_accuracy(spark, sf_dir):
    test = _emb_split(spark, sf_dir)[1]
    n = test.count()
    sh = spl.shards(test, "vec_id", 3, SEED, n=n)
    return met.shard_accuracy(_scored(sh), n, 3).withColumn("accuracy", F.round("accuracy", 9))


@query("g5_running_loss", _EMB_SCORE_SQL + """,
train AS (SELECT * FROM ranked WHERE rnk <= floor(0.7::DOUBLE * n)),
ep AS (SELECT t.vec_id, t.loss, e.epoch,
              row_number() OVER (PARTITION BY e.epoch
                                 ORDER BY md5('42:' || e.epoch || ':' || t.vec_id), t.vec_id) AS r
       FROM train t CROSS JOIN range(0, 3) e(epoch))
SELECT CAST(epoch AS INTEGER) AS epoch, round(avg(bl), 6) AS training_loss
FROM (SELECT epoch, (r - 1) // 20 AS b, avg(loss) AS bl FROM ep GROUP BY epoch, b)
GROUP BY epoch""")
def g5_running_loss(spark, sf_dir):
    from strata.session import materialize
    # scored once; the epochs only need keys and losses
    train = materialize(_scored(_emb_split(spark, sf_dir)[0]).select("vec_id", "loss"), "train-losses")
    parts = []
    for ep in range(3):
        b = spl.batches(train, "vec_id", 20, SEED, ep)
        parts.append(b.groupBy("batch_id").agg(F.avg("loss").alias("batch_loss"))
                     .withColumn("epoch", F.lit(ep)))
    bl = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return met.running_loss(bl, by=["epoch"]).select(
        "epoch", F.round("training_loss", 6).alias("training_loss"))


# ------------------------------------------------------------ D: resampling


def _rare2_vec(spark, sf_dir):
    return proj.assemble_features(fx.rare2(spark, sf_dir), fx.RARE2_FEATURES,
                                  keep=["event_id", "Class"])


_RARE2_MIN_SQL = f"""
WITH r AS ({RARE2_SQL}),
m AS (SELECT event_id, CAST(hour AS DOUBLE) AS f0, CAST(day AS DOUBLE) AS f1,
             CAST(user_id AS DOUBLE) AS f2, CAST(k AS DOUBLE) AS f3 FROM r WHERE Class = 1),
pairs AS (SELECT a.event_id, b.event_id AS nbr_key,
                 (a.f0 - b.f0) * (a.f0 - b.f0) + (a.f1 - b.f1) * (a.f1 - b.f1)
                 + (a.f2 - b.f2) * (a.f2 - b.f2) + (a.f3 - b.f3) * (a.f3 - b.f3) AS d2
          FROM m a JOIN m b ON a.event_id <> b.event_id),
nn AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY d2, nbr_key) - 1 AS nbr_rank
       FROM pairs),
knn AS (SELECT * FROM nn WHERE nbr_rank < 5),
mr AS (SELECT *, row_number() OVER (ORDER BY md5('42:minority:' || event_id), event_id) AS base FROM m),
plan AS (SELECT CAST(floor(0.03::DOUBLE * (SELECT count(*) FROM r WHERE Class = 0)
                      - (SELECT count(*) FROM m)) AS BIGINT) AS n_syn,
                (SELECT count(*) FROM m) AS n_min),
ids AS (SELECT unnest(range(0, n_syn)) AS i, n_min FROM plan),
draws AS (SELECT i, n_min,
                 ('0x' || substr(md5('42:smote:' || i), 1, 8))::BIGINT / {_dlit(4294967296.0)} AS u1,
                 ('0x' || substr(md5('42:smote:' || i), 9, 8))::BIGINT / {_dlit(4294967296.0)} AS gap
          FROM ids),
pick AS (SELECT i, gap, CAST(floor(u1 * (n_min * 5)) AS BIGINT) // 5 + 1 AS base,
                CAST(floor(u1 * (n_min * 5)) AS BIGINT) % 5 AS nbr_rank FROM draws),
syn AS (SELECT -(p.i + 1) AS event_id,
               x.f0 + p.gap * (y.f0 - x.f0) AS f0, x.f1 + p.gap * (y.f1 - x.f1) AS f1,
               x.f2 + p.gap * (y.f2 - x.f2) AS f2, x.f3 + p.gap * (y.f3 - x.f3) AS f3
        FROM pick p JOIN mr x ON p.base = x.base
        JOIN knn k ON k.event_id = x.event_id AND k.nbr_rank = p.nbr_rank
        JOIN m y ON y.event_id = k.nbr_key)"""


@query("d1_resample_plan", f"""
WITH c AS (SELECT Class, count(*) AS n FROM ({RARE2_SQL}) GROUP BY Class),
s AS (SELECT Class, n, CAST(CASE WHEN n = max(n) OVER () THEN n
                  ELSE n + floor(0.03::DOUBLE * max(n) OVER () - n) END AS BIGINT) AS n_smote FROM c)
SELECT Class, n, n_smote,
       CAST(CASE WHEN n_smote = min(n_smote) OVER () THEN n_smote
            ELSE floor(min(n_smote) OVER () / 0.3::DOUBLE) END AS BIGINT) AS n_final
FROM s""")
def d1_resample_plan(spark, sf_dir):
    return rs.resample_plan(fx.rare2(spark, sf_dir), "Class", 0.03, 0.3)


@query("d2_minority_knn", _RARE2_MIN_SQL + """
SELECT event_id, CAST(nbr_rank AS INTEGER) AS nbr_rank, nbr_key, d2 FROM knn""")
def d2_minority_knn(spark, sf_dir):
    m = _rare2_vec(spark, sf_dir).filter(F.col("Class") == 1).select("event_id", "features")
    return rs.knn(m, "event_id", "features", 5)


@query("d3_smote_rows", _RARE2_MIN_SQL + """
SELECT event_id, CAST(idx AS INTEGER) AS idx, round(v, 6) AS value FROM
  (SELECT event_id, unnest(range(0, 4)) AS idx, unnest([f0, f1, f2, f3]) AS v FROM syn)""")
def d3_smote_rows(spark, sf_dir):
    df = _rare2_vec(spark, sf_dir)
    counts = rs.class_counts(df, "Class")
    n_new = rs.oversample_targets(counts, 0.03)[1]
    m = df.filter(F.col("Class") == 1).select("event_id", "features")
    syn = rs.smote_rows(m, "event_id", "features", n_new, SEED).synthetic
    return syn.select("event_id", F.posexplode("features").alias("idx", "value")).select(
        "event_id", F.col("idx").cast("int").alias("idx"), F.round("value", 6).alias("value"))


def _b7_sql() -> str:
    cast = ", ".join(f"CAST(CAST(f{i} AS FLOAT) AS DOUBLE) AS f{i}" for i in range(4))
    scaled = ", ".join(f"(f{i} - min(f{i}) OVER ()) / (max(f{i}) OVER () - min(f{i}) OVER ())" for i in range(4))
    return _RARE2_MIN_SQL + f""",
allrows AS (SELECT event_id, CAST(hour AS DOUBLE) AS f0, CAST(day AS DOUBLE) AS f1,
                   CAST(user_id AS DOUBLE) AS f2, CAST(k AS DOUBLE) AS f3 FROM r
            UNION ALL SELECT event_id, f0, f1, f2, f3 FROM syn),
cast32 AS (SELECT event_id, {cast} FROM allrows),
scaled AS (SELECT event_id, [{scaled}] AS f FROM cast32)
SELECT event_id, CAST(idx AS INTEGER) AS idx, round(v, 6) AS value FROM
  (SELECT event_id, unnest(range(0, 4)) AS idx, unnest(f) AS v FROM scaled)"""


@query("b7_cast_then_scale", _b7_sql())
def b7_cast_then_scale(spark, sf_dir):
    """B7 in the reference order: over-sample all rows, cast to float32, then scale."""
    res = rs.smote(_rare2_vec(spark, sf_dir), "event_id", "Class", ratio=0.03, seed=SEED)
    wide = res.select("event_id", *[F.get("features", F.lit(i)).alias(c)
                                    for i, c in enumerate(fx.RARE2_FEATURES)])
    scaled = feat.minmax_scale(proj.cast_features(wide, fx.RARE2_FEATURES), fx.RARE2_FEATURES)
    return scaled.select("event_id", F.posexplode(F.array(*fx.RARE2_FEATURES)).alias("idx", "value")).select(
        "event_id", F.col("idx").cast("int").alias("idx"), F.round("value", 6).alias("value"))


@query("d4_undersample", f"""
WITH r AS ({RARE2_SQL}),
maj AS (SELECT event_id, row_number() OVER (ORDER BY md5('42:under:' || event_id), event_id) AS rnk
        FROM r WHERE Class = 0)
SELECT event_id, Class FROM r WHERE Class = 1
UNION ALL
SELECT event_id, 0 AS Class FROM maj
WHERE rnk <= CAST(floor((SELECT count(*) FROM r WHERE Class = 1) / 0.3::DOUBLE) AS BIGINT)""")
def d4_undersample(spark, sf_dir):
    return rs.undersample(fx.rare2(spark, sf_dir), "event_id", "Class", 0.3, SEED) \
        .select("event_id", "Class")


@query("d5_smote_undersample", _RARE2_MIN_SQL + """,
allr AS (SELECT event_id, Class FROM r UNION ALL SELECT event_id, 1 AS Class FROM syn),
maj AS (SELECT event_id, row_number() OVER (ORDER BY md5('42:under:' || event_id), event_id) AS rnk
        FROM allr WHERE Class = 0)
SELECT event_id, Class FROM allr WHERE Class = 1
UNION ALL
SELECT event_id, 0 AS Class FROM maj
WHERE rnk <= CAST(floor((SELECT count(*) FROM allr WHERE Class = 1) / 0.3::DOUBLE) AS BIGINT)""")
def d5_smote_undersample(spark, sf_dir):
    out = rs.smote_then_undersample(_rare2_vec(spark, sf_dir), "event_id", "Class", "features",
                                    0.03, 0.3, SEED)
    return out.select("event_id", "Class")


# ------------------------------------------------------------ F6-F11: gradients, Adam, training


SOFTMAX_LAYERS = [64, 10]

_GRAD_SQL = _mlp_sql(SOFTMAX_LAYERS, SEED, EMB_X_SQL, "vec_id") + """,
zm AS (SELECT *, max(logit) OVER (PARTITION BY vec_id) AS m FROM z),
p AS (SELECT vec_id, idx, exp(logit - m) / sum(exp(logit - m)) OVER (PARTITION BY vec_id) AS p
      FROM zm),
d AS (SELECT p.vec_id, p.idx, p.p - CASE WHEN e.label = p.idx THEN 1 ELSE 0 END AS d
      FROM p JOIN embeddings e ON e.vec_id = p.vec_id),
nn AS (SELECT count(*) AS n FROM embeddings),
g AS (SELECT 0 AS layer, d.idx AS i, h0.j AS j, sum(d.d * h0.x) / (SELECT n FROM nn) AS grad
      FROM d JOIN h0 ON d.vec_id = h0.vec_id GROUP BY d.idx, h0.j
      UNION ALL
      SELECT 0 AS layer, idx AS i, -1 AS j, sum(d) / (SELECT n FROM nn) AS grad FROM d GROUP BY idx)"""


@query("f6_gradient", _GRAD_SQL + """
SELECT CAST(layer AS INTEGER) AS layer, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
       round(grad, 9) AS grad FROM g""")
def f6_gradient(spark, sf_dir):
    g = tr.gradient(fx.emb10(spark, sf_dir), mlp.init_params(SOFTMAX_LAYERS, SEED))
    return g.select("layer", "i", "j", F.round("grad", 9).alias("grad"))


def _adam_sql() -> str:
    b = mlp.layer_bound(0, 1, 64, 10)
    lr = 1e-3
    bc1 = 1.0 - mlp.ADAM_BETA1
    bc2 = 1.0 - mlp.ADAM_BETA2
    return _GRAD_SQL + f""",
w AS (SELECT i, j, {_dlit(b)} * (2 * (('0x' || substr(md5('{SEED}:0:' || i || ':' || j), 1, 8))::BIGINT
             / {_dlit(4294967296.0)}) - 1) AS w FROM range(0, 10) a(i), range(0, 64) b(j)
      UNION ALL SELECT i, -1 AS j, 0.0::DOUBLE AS w FROM range(0, 10) a(i)),
st AS (SELECT g.layer, g.i, g.j, w.w, {_dlit(1.0 - mlp.ADAM_BETA1)} * g.grad AS m,
              {_dlit(1.0 - mlp.ADAM_BETA2)} * g.grad * g.grad AS v
       FROM g JOIN w ON g.i = w.i AND g.j = w.j)
SELECT CAST(layer AS INTEGER) AS layer, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
       round(w - {_dlit(lr / bc1)} * m / (sqrt(v) / {_dlit(float(np.sqrt(bc2)))} + {_dlit(mlp.ADAM_EPS)}), 9) AS w
FROM st"""


@query("f7_adam_step", _adam_sql())
def f7_adam_step(spark, sf_dir):
    g = tr.gradient(fx.emb10(spark, sf_dir), mlp.init_params(SOFTMAX_LAYERS, SEED))
    p = mdl.init_params_df(spark, SOFTMAX_LAYERS, SEED).drop("trial_id")
    out = tr.adam_step_table(p, g, 1e-3)
    return out.select("layer", "i", "j", F.round("w", 9).alias("w"))


def _two_steps_sql() -> str:
    """Two full-batch Adam steps of the softmax layer, as a chain of tables."""
    init = _adam_sql().replace("_GRAD_SQL", "")
    head = init[:init.rindex("SELECT CAST(layer AS INTEGER)")]
    b1, b2 = mlp.ADAM_BETA1, mlp.ADAM_BETA2

    def step(w, m, v, t):
        c1, c2 = 1.0 - b1 ** t, 1.0 - b2 ** t
        return (f"{w} - {_dlit(1e-3 / c1)} * {m} / (sqrt({v}) / {_dlit(float(np.sqrt(c2)))} "
                f"+ {_dlit(mlp.ADAM_EPS)})")

    return head.rstrip() + f""",
w1 AS (SELECT i, j, m, v, {step('w', 'm', 'v', 1)} AS w FROM st),
z1 AS (SELECT h0.vec_id, w1.i AS idx, sum(h0.x * w1.w) + max(b.w) AS logit
       FROM h0 JOIN w1 ON h0.j = w1.j JOIN w1 b ON b.i = w1.i AND b.j = -1 GROUP BY h0.vec_id, w1.i),
zm1 AS (SELECT *, max(logit) OVER (PARTITION BY vec_id) AS mx FROM z1),
d1 AS (SELECT q.vec_id, q.idx, q.p - CASE WHEN e.label = q.idx THEN 1 ELSE 0 END AS d
       FROM (SELECT vec_id, idx, exp(logit - mx) / sum(exp(logit - mx)) OVER (PARTITION BY vec_id) AS p
             FROM zm1) q JOIN embeddings e ON e.vec_id = q.vec_id),
g1 AS (SELECT d1.idx AS i, h0.j AS j, sum(d1.d * h0.x) / (SELECT n FROM nn) AS grad
       FROM d1 JOIN h0 ON d1.vec_id = h0.vec_id GROUP BY d1.idx, h0.j
       UNION ALL SELECT idx, -1, sum(d) / (SELECT n FROM nn) FROM d1 GROUP BY idx),
s2 AS (SELECT w1.i, w1.j, w1.w, {_dlit(b1)} * w1.m + {_dlit(1.0 - b1)} * g1.grad AS m,
              {_dlit(b2)} * w1.v + {_dlit(1.0 - b2)} * g1.grad * g1.grad AS v
       FROM w1 JOIN g1 ON w1.i = g1.i AND w1.j = g1.j)
SELECT CAST(0 AS INTEGER) AS layer, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
       round({step('w', 'm', 'v', 2)}, 7) AS w, round(m, 7) AS m, round(v, 9) AS v FROM s2"""


def _state_rows(spark, state):
    """Parameters and moments of a state as a table."""
    import uuid
    from strata.session import scratch_path
    path = scratch_path(spark, f"state-{uuid.uuid4().hex}")
    tr.write_checkpoint(spark, path, 0, state)
    df = tr.checkpoint_rows(spark.read.parquet(path))
    return df.select("layer", "i", "j", F.round("w", 7).alias("w"), F.round("m", 7).alias("m"),
                     F.round("v", 9).alias("v"))


@query("f9_sync_full_batch_weights", _two_steps_sql())
def f9_sync_full_batch_weights(spark, sf_dir):
    """two epochs of one full batch each."""
    emb = fx.emb10(spark, sf_dir)
    n = emb.count()
    state = tr.train_mlp(emb, "vec_id", SOFTMAX_LAYERS, lr=1e-3, batch_size=n, epochs=2,
                         mode="sync", seed=SEED).state
    return _state_rows(spark, state)


@query("f11_resume_weights", _two_steps_sql())
def f11_resume_weights(spark, sf_dir):
    """One epoch, its checkpoint written and read back, one more epoch."""
    import uuid
    from strata.session import scratch_path
    emb = fx.emb10(spark, sf_dir)
    n, path = emb.count(), scratch_path(spark, f"f11-{uuid.uuid4().hex}")
    tr.train_mlp(emb, "vec_id", SOFTMAX_LAYERS, lr=1e-3, batch_size=n, epochs=1, mode="sync",
                 seed=SEED, checkpoint_path=path)
    back = tr.read_checkpoint(spark, path, 0, SOFTMAX_LAYERS)
    state = tr.train_mlp(emb, "vec_id", SOFTMAX_LAYERS, lr=1e-3, batch_size=n, epochs=1,
                         mode="sync", seed=SEED, init=back).state
    return _state_rows(spark, state)


def _local_sql(w: int) -> str:
    """One full-shard Adam step on each of w padded shards, averaged."""
    head = _adam_sql()
    head = head[:head.index("\nnn AS (")]
    init = _adam_sql()
    init = init[init.index("w AS (SELECT i, j,"):init.index("\nst AS (")].rstrip(",")
    b1, b2, eps = mlp.ADAM_BETA1, mlp.ADAM_BETA2, mlp.ADAM_EPS
    c1, c2 = 1.0 - b1, 1.0 - b2
    return head + f"""
r AS (SELECT vec_id, row_number() OVER (ORDER BY md5('42:' || vec_id), vec_id) - 1 AS pos,
             count(*) OVER () AS n FROM embeddings),
sh AS (SELECT vec_id, pos % {w} AS shard FROM r
       UNION ALL SELECT vec_id, (pos + n) % {w} FROM r WHERE pos < ({w} - n % {w}) % {w}),
c AS (SELECT shard, count(*) AS k FROM sh GROUP BY shard),
g AS (SELECT sh.shard, d.idx AS i, h0.j AS j, sum(d.d * h0.x) / max(c.k) AS grad
      FROM sh JOIN c ON c.shard = sh.shard JOIN d ON d.vec_id = sh.vec_id
      JOIN h0 ON h0.vec_id = sh.vec_id GROUP BY sh.shard, d.idx, h0.j
      UNION ALL
      SELECT sh.shard, d.idx, -1, sum(d.d) / max(c.k)
      FROM sh JOIN c ON c.shard = sh.shard JOIN d ON d.vec_id = sh.vec_id GROUP BY sh.shard, d.idx),
{init},
s AS (SELECT g.i, g.j, w.w - {_dlit(1e-3 / c1)} * {_dlit(1.0 - b1)} * g.grad
             / (sqrt({_dlit(1.0 - b2)} * g.grad * g.grad) / {_dlit(float(np.sqrt(c2)))} + {_dlit(eps)}) AS w,
             {_dlit(1.0 - b1)} * g.grad AS m, {_dlit(1.0 - b2)} * g.grad * g.grad AS v
      FROM g JOIN w ON g.i = w.i AND g.j = w.j)
SELECT CAST(0 AS INTEGER) AS layer, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
       round(avg(w), 7) AS w, round(avg(m), 7) AS m, round(avg(v), 9) AS v FROM s GROUP BY i, j"""


@query("f10_local_average_weights", _local_sql(16))
def f10_local_average_weights(spark, sf_dir):
    """F10 local mode: 16 padded shards take one full-shard step each, then average."""
    emb = fx.emb10(spark, sf_dir)
    per_shard = -(-emb.count() // 16)
    state = tr.train_mlp(emb, "vec_id", SOFTMAX_LAYERS, lr=1e-3, batch_size=16 * per_shard,
                         epochs=1, world_size=16, seed=SEED).state
    return _state_rows(spark, state)


@query("f10_train_local_metrics")
def f10_train_local_metrics(spark, sf_dir):
    """F8-F10 (local mode, 3 shards): per-epoch test metrics."""
    train, test = _emb_split(spark, sf_dir)
    res = tr.train_mlp(train, "vec_id", EMB_LAYERS, lr=1e-3, batch_size=30, epochs=3,
                       world_size=3, seed=SEED, eval_df=test)
    return res.metrics


@query("f9_train_sync_reports")
def f9_train_sync_reports(spark, sf_dir):
    """F9 sync mode: exact global mini-batch Adam, one gradient job per batch."""
    train, _ = _emb_split(spark, sf_dir)
    n = train.count()
    res = tr.train_mlp(train, "vec_id", EMB_LAYERS, lr=1e-3, batch_size=max(1, n // 4),
                       epochs=1, mode="sync", seed=SEED)
    return res.reports


@query("f11_resume_reports")
def f11_resume_reports(spark, sf_dir):
    """one epoch, checkpoint, resume for one more; reports of both runs."""
    from strata.session import ensure_checkpoint_dir, scratch_path
    import uuid
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, f"f11-{uuid.uuid4().hex}")
    train, _ = _emb_split(spark, sf_dir)
    first = tr.train_mlp(train, "vec_id", EMB_LAYERS, lr=1e-3, batch_size=20, epochs=1,
                         world_size=2, seed=SEED, checkpoint_path=path)
    state = tr.read_checkpoint(spark, path, 0, EMB_LAYERS)
    second = tr.train_mlp(train, "vec_id", EMB_LAYERS, lr=1e-3, batch_size=20, epochs=1,
                          world_size=2, seed=SEED, init=state)
    return first.reports.unionByName(second.reports)


# ------------------------------------------------------------ H: search as tables


_SPACE_COLS = ["batch_size", "l1", "l2", "l3", "lr", "num_workers"]


def _draw_sql(param: str, key_expr: str) -> str:
    return (f"(('0x' || substr(md5('{SEED}:' || {key_expr} || ':{param}'), 1, 8))::BIGINT"
            f" / {_dlit(4294967296.0)})")


def _trials_sql(key_expr: str, src: str) -> str:
    a, b = math.log(1e-4), math.log(1e-1)
    u = lambda p: _draw_sql(p, key_expr)
    return f"""
SELECT CAST({key_expr} AS INTEGER) AS trial_id,
       [20, 40, 60, 80][CAST(floor({u('batch_size')} * 4) AS INTEGER) + 1] AS batch_size,
       CAST(pow(2, 6 + floor({u('l1')} * 4)) AS INTEGER) AS l1,
       CAST(pow(2, 5 + floor({u('l2')} * 4)) AS INTEGER) AS l2,
       CAST(pow(2, 3 + floor({u('l3')} * 4)) AS INTEGER) AS l3,
       round(exp({_dlit(a)} + {u('lr')} * {_dlit(b - a)}), 12) AS lr,
       [1, 2][CAST(floor({u('num_workers')} * 2) AS INTEGER) + 1] AS num_workers
FROM {src}"""


def _user_trials(spark, sf_dir):
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return srch.trials_from_ids(users, "user_id", srch.reference_space(), SEED,
                                config_cols=["batch_size", "l1", "l2", "l3", "lr"])


@query("h4_trial_draws", _trials_sql("user_id", "(SELECT DISTINCT user_id FROM events)"))
def h4_trial_draws(spark, sf_dir):
    t = _user_trials(spark, sf_dir)
    return t.select("trial_id", "config.*", "num_workers").withColumn(
        "lr", F.round("lr", 12))


_REPORTS_SQL = """
SELECT CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS trial_id,
       CAST(day(ts) AS INTEGER) AS epoch,
       avg(value) AS training_loss, min(event_id) AS report_seq
FROM events GROUP BY hour(ts) * 60 + minute(ts), day(ts)"""


def _event_reports(spark, sf_dir):
    """A reports table derived from all events: trial = minute of the day
    (at most 1,440 trials whatever the data size, as a search has a bounded
    number of trials), epoch = day of month, loss = mean value, arrival =
    first event id.  The group-by pre-aggregates map-side."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy((F.hour("ts") * 60 + F.minute("ts")).cast("int").alias("trial_id"),
                      F.dayofmonth("ts").cast("int").alias("epoch")).agg(
        F.avg("value").alias("training_loss"), F.min("event_id").alias("report_seq"))


def _report_trials(spark, sf_dir):
    ids = _event_reports(spark, sf_dir).select("trial_id").distinct()
    return srch.trials_from_ids(ids, "trial_id", srch.reference_space(), SEED,
                                config_cols=["batch_size", "l1", "l2", "l3", "lr"])


def _asha_sql(max_t: int, reports: str | None = None) -> str:
    ms = srch.rung_milestones(max_t)
    case = " ".join(f"WHEN epoch >= {m} THEN {m}" for m in reversed(ms))
    parts = [f"rep AS ({reports or _REPORTS_SQL})",
             f"r AS (SELECT *, CASE {case} END AS rung FROM rep WHERE epoch < {max_t})",
             "f AS (SELECT trial_id, rung, arg_min(epoch, report_seq) AS epoch, "
             "arg_min(training_loss, report_seq) AS training_loss, min(report_seq) AS report_seq "
             "FROM r WHERE rung IS NOT NULL GROUP BY trial_id, rung)"]
    for k, m in enumerate(ms):
        excl = f" AND trial_id NOT IN (SELECT trial_id FROM s{k - 1})" if k else ""
        parts.append(
            f"d{k} AS (SELECT *, quantile_cont(training_loss, 0.5) OVER (ORDER BY report_seq "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cutoff "
            f"FROM f WHERE rung = {m}{excl})")
        prev = f" UNION ALL SELECT trial_id FROM s{k - 1}" if k else ""
        parts.append(f"s{k} AS (SELECT trial_id FROM d{k} WHERE training_loss > cutoff{prev})")
    sel = " UNION ALL ".join(
        f"SELECT trial_id, CAST(rung AS INTEGER) AS rung, epoch, round(training_loss, 6) AS "
        f"training_loss, report_seq, round(cutoff, 6) AS cutoff, "
        f"CAST(coalesce(training_loss > cutoff, false) AS INTEGER) AS stop FROM d{k}"
        for k in range(len(ms)))
    return "WITH " + ",\n".join(parts) + "\n" + sel


@query("h6_asha_prune", _asha_sql(31))
def h6_asha_prune(spark, sf_dir):
    d = srch.asha_prune(_event_reports(spark, sf_dir), max_t=31, grace_period=1,
                        reduction_factor=2)
    return d.select("trial_id", F.col("rung").cast("int").alias("rung"), "epoch",
                    F.round("training_loss", 6).alias("training_loss"), "report_seq",
                    F.round("cutoff", 6).alias("cutoff"), "stop")


_ALL_TRIALS_SQL = """
    SELECT event_id // 4 AS trial_id, CAST(event_id % 4 + 1 AS INTEGER) AS epoch, value AS training_loss,
           event_id AS report_seq FROM events"""


@query("h6_asha_prune_all_trials", _asha_sql(5, _ALL_TRIALS_SQL))
def h6_asha_prune_all_trials(spark, sf_dir):
    """H6 with a trial for every four events: as many trials as the table gives."""
    ev = table(spark, sf_dir, "events")
    reports = ev.select(F.floor(F.col("event_id") / 4).alias("trial_id"), (F.col("event_id") % 4 + 1).cast("int").alias("epoch"),
                        F.col("value").alias("training_loss"), F.col("event_id").alias("report_seq"))
    d = srch.asha_prune(reports, max_t=5, grace_period=1, reduction_factor=2)
    return d.select("trial_id", F.col("rung").cast("int").alias("rung"), "epoch",
                    F.round("training_loss", 6).alias("training_loss"), "report_seq",
                    F.round("cutoff", 6).alias("cutoff"), "stop")


_BEST_SQL = f"""
WITH rep AS ({_REPORTS_SQL}),
last AS (SELECT trial_id, max(epoch) AS epoch, arg_max(training_loss, epoch) AS training_loss
         FROM rep GROUP BY trial_id),
best AS (SELECT * FROM last ORDER BY training_loss, trial_id LIMIT 1)"""


@query("h7_best_trial", _BEST_SQL + """
SELECT trial_id, epoch, round(training_loss, 6) AS training_loss FROM best""")
def h7_best_trial(spark, sf_dir):
    b = srch.best_trial(_event_reports(spark, sf_dir))
    return b.select("trial_id", "epoch", F.round("training_loss", 6).alias("training_loss"))


@query("h8_best_config", _BEST_SQL + """,
tr AS (""" + _trials_sql("trial_id", "(SELECT DISTINCT trial_id FROM rep)") + """)
SELECT b.trial_id, b.epoch, tr.batch_size, tr.l1, tr.l2, tr.l3, tr.lr, tr.num_workers
FROM best b JOIN tr ON b.trial_id = tr.trial_id""")
def h8_best_config(spark, sf_dir):
    b = srch.best_trial(_event_reports(spark, sf_dir))
    c = srch.best_config(b, _report_trials(spark, sf_dir))
    return c.select("trial_id", "epoch", "config.batch_size", "config.l1", "config.l2",
                    "config.l3", F.round("config.lr", 12).alias("lr"), "num_workers")


def _emb_search(spark, sf_dir, n_trials=4, max_epochs=4):
    from strata.session import ensure_checkpoint_dir, scratch_path
    import uuid
    ensure_checkpoint_dir(spark)
    train, test = _emb_split(spark, sf_dir)
    trials = srch.make_trials(spark, n_trials, srch.reference_space(), SEED,
                              config_cols=["batch_size", "l1", "l2", "l3", "lr"])
    res = srch.run_search(train, "vec_id", trials, in_width=64, n_classes=10,
                          max_epochs=max_epochs, seed=SEED,
                          checkpoint_path=scratch_path(spark, f"search-{uuid.uuid4().hex}"))
    return res, test


@query("h5_search_reports")
def h5_search_reports(spark, sf_dir):
    """H5: a 4-trial search with early stopping on the embeddings train split."""
    res, _ = _emb_search(spark, sf_dir)
    return res.reports


@query("h9_test_best")
def h9_test_best(spark, sf_dir):
    """H7-H9 end to end: best trial of the search, loaded strictly from its
    checkpoint, tested on the held-out split with 2 workers."""
    res, test = _emb_search(spark, sf_dir)
    return srch.evaluate_best(res, test, "vec_id", in_width=64, n_classes=10, world_size=2,
                          batch_size=10, seed=SEED)


# ------------------------------------------------------------ A: sources and sinks


def _scratch(spark, name):
    import uuid
    from strata.session import ensure_checkpoint_dir, scratch_path
    ensure_checkpoint_dir(spark)
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@query("a1_csv_header_scan", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def a1_csv_header_scan(spark, sf_dir):
    """A1: orders written as CSV with a header, read back with an explicit schema."""
    cols = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, " \
           "o_totalprice double, o_orderpriority string"
    path = _scratch(spark, "a1")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                               "o_totalprice", "o_orderpriority")
    csvsrc.write_csv(o, path, header=True)
    return csvsrc.read_csv(spark, path, cols, header=True)


@query("a2_csv_positional_scan", FLAG3_SQL)
def a2_csv_positional_scan(spark, sf_dir):
    """A2: the 3-class table as headerless CSV, columns named by position."""
    path = _scratch(spark, "a2")
    csvsrc.write_csv(fx.flag3(spark, sf_dir), path, header=False)
    return csvsrc.read_csv_positional(spark, path, fx.FLAG3_FEATURES + ["l_returnflag"],
                                      ["double"] * 4 + ["string"])


@query("a5_append_reports", f"""
SELECT trial_id, epoch, round(training_loss, 9) AS training_loss, report_seq
FROM ({_REPORTS_SQL})""")
def a5_append_reports(spark, sf_dir):
    """A5: reports appended in two epochs' worth of writes, read back whole."""
    path = _scratch(spark, "a5")
    rep = _event_reports(spark, sf_dir)
    repsrc.append_reports(rep.filter(F.col("epoch") <= 15), path)
    repsrc.append_reports(rep.filter(F.col("epoch") > 15), path)
    return repsrc.read_reports(spark, path).withColumn(
        "training_loss", F.round("training_loss", 9))


_SEEDS_SQL = " UNION ALL ".join(
    _mlp_sql(EMB_LAYERS, s, EMB_X_SQL, "vec_id").replace("WITH ", f"SELECT {e} AS epoch, * FROM (WITH ", 1)
    + " SELECT * FROM z)" for e, s in enumerate([SEED, SEED + 1, SEED + 2]))

_G6_SQL = f"""
WITH zz AS ({_SEEDS_SQL}),
lse AS (SELECT epoch, vec_id, ln(sum(exp(logit - m))) + m AS lse
        FROM (SELECT *, max(logit) OVER (PARTITION BY epoch, vec_id) AS m FROM zz)
        GROUP BY epoch, vec_id, m),
pred AS (SELECT epoch, vec_id, idx AS prediction FROM
         (SELECT *, row_number() OVER (PARTITION BY epoch, vec_id ORDER BY logit DESC, idx) AS r
          FROM zz) WHERE r = 1),
ranked AS (SELECT vec_id, label, row_number() OVER (ORDER BY md5('42:' || vec_id), vec_id) AS rnk,
                  count(*) OVER () AS n FROM embeddings),
test AS (SELECT vec_id, label FROM ranked WHERE rnk > floor(0.7::DOUBLE * n)),
sc AS (SELECT p.epoch, t.vec_id, l.lse - z.logit AS loss,
              CAST(p.prediction = t.label AS DOUBLE) AS hit
       FROM test t JOIN pred p ON p.vec_id = t.vec_id
       JOIN lse l ON l.vec_id = t.vec_id AND l.epoch = p.epoch
       JOIN zz z ON z.vec_id = t.vec_id AND z.epoch = p.epoch AND z.idx = t.label),
ms AS (SELECT CAST(epoch AS INTEGER) AS epoch, avg(loss) AS loss, avg(hit) AS accuracy
       FROM sc GROUP BY epoch)"""


def _g6_metrics(spark, sf_dir):
    _, test = _emb_split(spark, sf_dir)
    parts = []
    for e, s in enumerate([SEED, SEED + 1, SEED + 2]):
        sc = mdl.with_loss(mdl.score(test, mlp.init_params(EMB_LAYERS, s)))
        parts.append(sc.withColumn("epoch", F.lit(e)))
    allsc = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return met.metric_series(allsc)


@query("g6_metric_series", _G6_SQL + """
SELECT epoch, round(loss, 6) AS loss, round(accuracy, 9) AS accuracy FROM ms""")
def g6_metric_series(spark, sf_dir):
    """(epoch, loss, accuracy) rows; 'epoch' e scores with the model of seed 42+e."""
    return _g6_metrics(spark, sf_dir).select(
        "epoch", F.round("loss", 6).alias("loss"), F.round("accuracy", 9).alias("accuracy"))


@query("a6_metric_lines", _G6_SQL + """
SELECT epoch, printf('Epoch %d validation: Avg loss=%.2f, Accuracy=%.1f%%', epoch, loss,
                     accuracy * 100.0) AS line FROM ms""")
def a6_metric_lines(spark, sf_dir):
    """The printed per-epoch line as a column."""
    return met.format_metrics(_g6_metrics(spark, sf_dir)).select("epoch", "line")


# ------------------------------------------------------------ flagship

def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders JOIN customer prepared (split 70/30 first, scaler fitted on the
    train part, drop-first dummies), scored by a seeded 34-16-2 MLP: rows,
    mean loss and accuracy per split."""
    from strata.plans.jobs import prepare_mixed2, score_table
    prep = prepare_mixed2(spark, sf_dir, fractions=(0.7, 0.3), seed=SEED)
    return score_table(prep, [prep.width, 16, 2], SEED)


# ------------------------------------------------------------ B: positional slices, casts, glue

@query("b3_all_but_last", """
SELECT l_quantity + 0.0 AS l_quantity, l_extendedprice + 0.0 AS l_extendedprice,
       l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax FROM lineitem""")
def b3_all_but_last(spark, sf_dir):
    """``[:, :-1]`` on the headerless 3-class layout (label last)."""
    return proj.all_but_last(fx.flag3(spark, sf_dir))


@query("b4_columns_from", "SELECT l_returnflag FROM lineitem")
def b4_columns_from(spark, sf_dir):
    """``[:, 4:]``, the label part of the same layout."""
    return proj.columns_from(fx.flag3(spark, sf_dir), 4)


@query("b7_cast_float", """
SELECT event_id, CAST(value AS FLOAT) AS value, CAST(user_id AS FLOAT) AS user_id FROM events""")
def b7_cast_float(spark, sf_dir):
    """Feature columns cast to float32."""
    ev = table(spark, sf_dir, "events").select("event_id", "value", "user_id")
    return proj.cast_features(ev, ["value", "user_id"], "float")


@query("b9_glue_label", f"""
SELECT event_id, hour, day, user_id, k, Class FROM ({RARE2_SQL})""")
def b9_glue_label(spark, sf_dir):
    """Features and label of the same rows side by side (a projection)."""
    return proj.concat_columns(fx.rare2(spark, sf_dir), ["event_id", *fx.RARE2_FEATURES], "Class")


@query("b10_overwrite_scaled", f"""
SELECT o_orderkey,
       (o_totalprice - min(o_totalprice) OVER ()) / (max(o_totalprice) OVER () - min(o_totalprice) OVER ()) AS o_totalprice,
       (c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()) AS c_acctbal,
       o_orderpriority, c_mktsegment, c_nationkey, target
FROM ({MIXED2_SQL})""")
def b10_overwrite_scaled(spark, sf_dir):
    """B10 (+C1/C2 on named columns): scaled values written over the originals."""
    df = fx.mixed2(spark, sf_dir)
    m = feat.minmax_fit(df, fx.MIXED2_NUMERIC)
    return proj.overwrite(df, {c: m.expr(c) for c in fx.MIXED2_NUMERIC})


@query("b12_fetch_rows", f"""
SELECT q.n_name AS nation, q.request, q.pos, e.event_id, e.value
FROM (SELECT n_name, CAST(n_nationkey AS BIGINT) AS request, (n_nationkey * 7919) % (SELECT count(*) FROM events) AS pos
      FROM nation) q
JOIN ({_rank_sql('SELECT event_id, value FROM events', 'event_id', '42:')}) e ON e.rnk - 1 = q.pos""")
def b12_fetch_rows(spark, sf_dir):
    """Rows at the positions that a table asks for."""
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    ranked = hash_rank(ev, "event_id", SEED).withColumn("pos", F.col("rank") - 1).drop("rank")
    asked = table(spark, sf_dir, "nation").select(
        "n_name", F.col("n_nationkey").cast("long").alias("request"),
        F.pmod(F.col("n_nationkey").cast("long") * 7919, F.lit(ev.count())).alias("pos"))
    names = asked.select("request", F.col("n_name").alias("nation"))
    return proj.fetch_rows(ranked, "pos", asked).join(names, "request")


@query("b12_fetch_by_directory", f"""
SELECT q.request, q.pos, e.event_id, e.user_id, e.value
FROM (SELECT CAST(i AS BIGINT) AS request, (i * 7919) % (SELECT count(*) FROM events) AS pos FROM range(0, 25) t(i)) q
JOIN ({_rank_sql('SELECT event_id, user_id, value FROM events', 'event_id', '42:')}) e ON e.rnk - 1 = q.pos""")
def b12_fetch_by_directory(spark, sf_dir):
    """25 listed positions from a stored rank directory; 25 buckets are read."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    held = RankDirectory.write(ev, "event_id", SEED, _scratch(spark, "directory"))
    return held.fetch([i * 7919 % len(held) for i in range(25)])


@query("b12_fetch_table_by_directory", f"""
SELECT CAST(q.l_orderkey * 8 + q.l_linenumber AS BIGINT) AS request, q.pos, e.event_id
FROM (SELECT l_orderkey, l_linenumber, (l_partkey * 31 + l_suppkey) % (SELECT count(*) FROM events) AS pos FROM lineitem) q
JOIN ({_rank_sql('SELECT event_id FROM events', 'event_id', '42:')}) e ON e.rnk - 1 = q.pos""")
def b12_fetch_table_by_directory(spark, sf_dir):
    """As many positions as lineitem has rows, asked for by a table."""
    held = RankDirectory.write(table(spark, sf_dir, "events").select("event_id"), "event_id", SEED, _scratch(spark, "directory"))
    asked = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("request"),
        F.pmod(F.col("l_partkey") * 31 + F.col("l_suppkey"), F.lit(len(held))).alias("pos"))
    return held.fetch(asked)


@query("c3_label_encode_types", """
SELECT l_orderkey, l_linenumber,
       CAST(dense_rank() OVER (ORDER BY p) - 1 AS INTEGER) AS p,
       CAST(dense_rank() OVER (ORDER BY q) - 1 AS INTEGER) AS q,
       CAST(dense_rank() OVER (ORDER BY d) - 1 AS INTEGER) AS d
FROM (SELECT l_orderkey, l_linenumber, CAST(l_discount AS DOUBLE) AS p,
             CAST(l_extendedprice AS DECIMAL(18, 2)) AS q, CAST(l_shipdate AS DATE) AS d FROM lineitem)""")
def c3_label_encode_types(spark, sf_dir):
    """C3 on a float, a decimal (very many levels) and a date column."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").cast("double").alias("p"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("q"),
        F.col("l_shipdate").cast("date").alias("d"))
    return feat.label_encode(li, ["p", "q", "d"])


@query("b12_dataset_length", "SELECT count(*) AS n FROM events")
def b12_dataset_length(spark, sf_dir):
    """The dataset length, as a one-row table."""
    return table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------ U1: user function per shard

def _shard_summary(batches):
    import pandas as pd
    acc = {}
    for pdf in batches:
        for s, g in pdf.groupby("shard"):
            n, v = acc.get(s, (0, 0.0))
            acc[s] = (n + len(g), v + float(g["value"].sum()))
    if acc:
        yield pd.DataFrame({"shard": list(acc), "rows": [a[0] for a in acc.values()],
                            "value_sum": [a[1] for a in acc.values()]})


@query("u1_map_shards", f"""
WITH s AS ({_SHARD_SQL})
SELECT CAST(shard AS INTEGER) AS shard, count(*) AS rows, round(sum(e.value), 6) AS value_sum
FROM s JOIN events e ON s.event_id = e.event_id GROUP BY shard""")
def u1_map_shards(spark, sf_dir):
    """A pandas function run on each shard's rows (3 padded shards)."""
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    sh = spl.shards(ev, "event_id", 3, SEED)
    out = tr.map_shards(sh.select("shard", "value"), _shard_summary,
                        "shard int, rows long, value_sum double", 3)
    return out.groupBy("shard").agg(F.sum("rows").alias("rows"),
                                    F.round(F.sum("value_sum"), 6).alias("value_sum"))


@query("f8_epoch_loop_fixed_order")
def f8_epoch_loop_fixed_order(spark, sf_dir):
    """F8 with E4: one worker's steps over batches of 128 in a fixed order with the
    tail dropped, rows read in several tasks, one job for 65,536 rows; whole-test-set loss and
    accuracy after every epoch."""
    from strata.plans.jobs import multiclass_job
    return multiclass_job(spark, sf_dir, epochs=3, batch_size=128, seed=SEED, mode="sync").metrics


@query("h5_resampled_search_reports")
def h5_resampled_search_reports(spark, sf_dir):
    """H5 on the rare-positive table: split, scale on train, SMOTE(0.03) +
    undersample(0.3) on the train split, 3 trials (one worker's steps each, rows
    read in several tasks, one job for 65,536 rows) with successive halving."""
    from strata.plans.jobs import imbalanced_search_job
    res, _ = imbalanced_search_job(spark, sf_dir, num_trials=3, max_epochs=3, seed=SEED, mode="sync",
                                   batch_sizes=(128, 256))
    return res.reports


from strata.plans import keyless, training  # noqa: E402,F401  (they register their queries here)
