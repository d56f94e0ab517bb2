"""Registered queries that train networks with hidden layers, and their oracles.

The oracle is back-propagation written as relations: per step a forward pass (a join and
a sum a layer), the output error, the errors of the layers below (a join and a sum
each), gradients as sums over rows, and Adam on the table of parameters.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from strata.operators import mlp
from strata.operators import search as srch
from strata.operators import train as tr
from strata.plans.catalog import SEED, _dlit, _emb_split, _state_rows, query
from strata.session import scratch_path

#: Learning rates of the four trials of the checked search; hidden widths of its networks.
RATES, HIDDEN = (2e-3, 5e-2, 1e-2, 2e-1), (12, 8, 8)
SEARCH_EPOCHS, STEPS_PER_EPOCH, WORKERS = 2, 2, 2


def _head(layers: list[int], seeds: dict[int, str], rates: dict[int, float]) -> str:
    """Ordered train rows, inputs, rates and initial parameters (``p0``)."""
    n = len(layers) - 1
    init = []
    for lay in range(n):
        fi, fo = layers[lay], layers[lay + 1]
        init.append(f"""SELECT trial, {lay} AS layer, i, j, {_dlit(mlp.layer_bound(lay, n, fi, fo))} * (2 * (
  ('0x' || substr(md5(seed || ':{lay}:' || i || ':' || j), 1, 8))::BIGINT / {_dlit(4294967296.0)}) - 1) AS w
  FROM rate, range(0, {fo}) a(i), range(0, {fi}) b(j)
UNION ALL SELECT trial, {lay}, i, -1, {_dlit(0.0)} FROM rate, range(0, {fo}) a(i)""")
    values = ", ".join(f"({t}, '{seeds[t]}', {_dlit(rates[t])})" for t in seeds)
    joined = "\nUNION ALL ".join(init)
    return f"""WITH ranked AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY md5('{SEED}:' || vec_id), vec_id) AS rnk, count(*) OVER () AS n FROM embeddings
), train AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY md5('{SEED}:' || vec_id), vec_id) - 1 AS pos, count(*) OVER () AS n
  FROM ranked WHERE rnk <= floor(0.7::DOUBLE * n)
), x AS MATERIALIZED (
  SELECT vec_id, unnest(range(0, len(embedding))) AS j, unnest(embedding)::DOUBLE AS x FROM embeddings
), rate(trial, seed, lr) AS (VALUES {values}
), p0 AS MATERIALIZED (SELECT *, {_dlit(0.0)} AS m, {_dlit(0.0)} AS v FROM ({joined}))"""


def _forward(name: str, params: str, rows: str, n_layers: int) -> str:
    """CTEs ``<name>h<l>`` (input of layer l) and ``<name>z`` (logits) of some rows."""
    out = f""",
{name}h0 AS MATERIALIZED (SELECT rate.trial, x.vec_id, x.j, x.x FROM x JOIN ({rows}) r ON r.vec_id = x.vec_id, rate)"""
    for lay in range(n_layers):
        last = lay == n_layers - 1
        value = "sum(h.x * w.w) + max(b.w)"
        cols = f"{value} AS logit" if last else f"greatest({value}, 0) AS x"
        out += f""",
{name}{'z' if last else f'h{lay + 1}'} AS MATERIALIZED (
  SELECT h.trial, h.vec_id, w.i AS {'idx' if last else 'j'}, {cols}
  FROM {name}h{lay} h JOIN {params} w ON w.trial = h.trial AND w.layer = {lay} AND w.j = h.j
  JOIN {params} b ON b.trial = h.trial AND b.layer = {lay} AND b.i = w.i AND b.j = -1 GROUP BY h.trial, h.vec_id, w.i)"""
    return out


def _step(t: int, n_layers: int, first: str, end: str) -> str:
    """Step t: CTEs of its batch, loss (``l<t>``) and parameters (``p<t>``)."""
    s, old = f"s{t}", f"p{t - 1}"
    out = f""",
{s}rows AS MATERIALIZED (SELECT vec_id, label FROM train WHERE pos >= {first} AND pos < {end})"""
    out += _forward(s, old, f"SELECT vec_id FROM {s}rows", n_layers)
    out += f""",
{s}q AS MATERIALIZED (
  SELECT z.*, mx + ln(sum(exp(logit - mx)) OVER w) AS lse FROM (
    SELECT *, max(logit) OVER (PARTITION BY trial, vec_id) AS mx FROM {s}z) z WINDOW w AS (PARTITION BY trial, vec_id)),
l{t} AS MATERIALIZED (
  SELECT trial, avg(lse - logit) AS loss FROM {s}q q JOIN {s}rows r ON r.vec_id = q.vec_id AND r.label = q.idx GROUP BY trial),
{s}d{n_layers - 1} AS MATERIALIZED (
  SELECT trial, q.vec_id, idx AS i, exp(logit - lse) - CASE WHEN r.label = idx THEN 1 ELSE 0 END AS d
  FROM {s}q q JOIN {s}rows r ON r.vec_id = q.vec_id)"""
    for lay in range(n_layers - 1, 0, -1):
        out += f""",
{s}d{lay - 1} AS MATERIALIZED (
  SELECT h.trial, h.vec_id, h.j AS i, CASE WHEN h.x > 0 THEN e.d ELSE 0 END AS d FROM (
    SELECT d.trial, d.vec_id, w.j, sum(d.d * w.w) AS d
    FROM {s}d{lay} d JOIN {old} w ON w.trial = d.trial AND w.layer = {lay} AND w.i = d.i AND w.j >= 0 GROUP BY d.trial, d.vec_id, w.j) e
  JOIN {s}h{lay} h ON h.trial = e.trial AND h.vec_id = e.vec_id AND h.j = e.j)"""
    grads = "\nUNION ALL ".join(
        f"SELECT d.trial, {lay} AS layer, d.i, h.j, sum(d.d * h.x) AS g FROM {s}d{lay} d "
        f"JOIN {s}h{lay} h ON h.trial = d.trial AND h.vec_id = d.vec_id GROUP BY d.trial, d.i, h.j\n"
        f"UNION ALL SELECT trial, {lay}, i, -1, sum(d) FROM {s}d{lay} GROUP BY trial, i" for lay in range(n_layers))
    b1, b2 = mlp.ADAM_BETA1, mlp.ADAM_BETA2
    c1, c2 = 1.0 - b1 ** t, 1.0 - b2 ** t
    return out + f""",
{s}g AS MATERIALIZED (SELECT trial, layer, i, j, g / (SELECT count(*) FROM {s}rows) AS g FROM ({grads})),
{s}m AS MATERIALIZED (
  SELECT p.trial, p.layer, p.i, p.j, p.w, {_dlit(b1)} * p.m + {_dlit(1.0 - b1)} * g AS m, {_dlit(b2)} * p.v + {_dlit(1.0 - b2)} * g * g AS v
  FROM {old} p JOIN {s}g g ON g.trial = p.trial AND g.layer = p.layer AND g.i = p.i AND g.j = p.j),
p{t} AS MATERIALIZED (
  SELECT a.trial, layer, i, j, w - lr / {_dlit(c1)} * m / (sqrt(v) / {_dlit(float(np.sqrt(c2)))} + {_dlit(mlp.ADAM_EPS)}) AS w, m, v
  FROM {s}m a JOIN rate ON rate.trial = a.trial)"""


#: Half of the train rows; as many rows in each step, an odd one is dropped.
_HALF = "(SELECT max(n) // 2 FROM train)"
_ONE = [64, 8, 10]

_WEIGHTS_SQL = (_head(_ONE, {0: str(SEED)}, {0: 1e-2})
                + "".join(_step(t, 2, f"{(t - 1) % 2} * {_HALF}", f"{(t - 1) % 2 + 1} * {_HALF}") for t in (1, 2, 3, 4)) + """
SELECT CAST(layer AS INTEGER) AS layer, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(w, 7) AS w, round(m, 7) AS m,
       round(v, 9) AS v FROM p4""")


@query("f8_hidden_layer_weights", _WEIGHTS_SQL)
def f8_hidden_layer_weights(spark, sf_dir):
    """F8 with E4: one worker, two epochs of two batches in a fixed order (an odd row
    dropped), rows read in several tasks: the weights after four steps."""
    train, _ = _emb_split(spark, sf_dir)
    state = tr.train_mlp(train, "vec_id", _ONE, lr=1e-2, batch_size=train.count() // 2, epochs=2, mode="sync",
                         shuffle=False, drop_last=True, seed=SEED).state
    return _state_rows(spark, state)


def _trained_search(spark, sf_dir):
    train, test = _emb_split(spark, sf_dir)
    batch = -(-train.count() // STEPS_PER_EPOCH)
    trials = spark.createDataFrame(
        [(t, (batch, *HIDDEN, lr), 1) for t, lr in enumerate(RATES)],
        "trial_id int, config struct<batch_size: int, l1: int, l2: int, l3: int, lr: double>, num_workers int")
    res = srch.run_search(train, "vec_id", trials, in_width=64, n_classes=10, max_epochs=SEARCH_EPOCHS, seed=SEED,
                          shuffle=False, mode="sync", checkpoint_path=scratch_path(spark, f"search-{uuid.uuid4().hex}"))
    return res, test


def _search_sql() -> str:
    """Reports of the search (``rep``): trials that lose at the first rung stop there."""
    layers, half = [64, *HIDDEN, 10], f"(SELECT (max(n) + {STEPS_PER_EPOCH - 1}) // {STEPS_PER_EPOCH} FROM train)"
    sql = _head(layers, {t: f"{SEED}:{t}" for t in range(len(RATES))}, dict(enumerate(RATES)))
    for t in range(1, SEARCH_EPOCHS * STEPS_PER_EPOCH + 1):
        b = (t - 1) % STEPS_PER_EPOCH
        sql += _step(t, len(layers) - 1, f"{b} * {half}", f"{b + 1} * {half}")
    return sql + """,
e1 AS (SELECT a.trial, (a.loss + b.loss) / 2 AS loss FROM l1 a JOIN l2 b ON a.trial = b.trial),
stopped AS (SELECT e.trial FROM e1 e WHERE e.loss > (SELECT quantile_cont(o.loss, 0.5) FROM e1 o WHERE o.trial < e.trial)),
e2 AS (SELECT a.trial, (a.loss + b.loss) / 2 AS loss FROM l3 a JOIN l4 b ON a.trial = b.trial
       WHERE a.trial NOT IN (SELECT trial FROM stopped)),
rep AS MATERIALIZED (SELECT trial, 1 AS epoch, loss, trial AS seq FROM e1
        UNION ALL SELECT trial, 2, loss, (SELECT count(*) FROM e1) + row_number() OVER (ORDER BY trial) - 1 FROM e2)"""


@query("h5_trained_reports", _search_sql() + """
SELECT CAST(trial AS INTEGER) AS trial_id, CAST(epoch AS INTEGER) AS epoch, round(loss, 6) AS training_loss,
       CAST(seq AS BIGINT) AS report_seq FROM rep""")
def h5_trained_reports(spark, sf_dir):
    """H5: four trials at different learning rates, three hidden layers, two steps
    an epoch; what loses at the first rung is stopped."""
    res, _ = _trained_search(spark, sf_dir)
    return res.reports.select("trial_id", "epoch", F.round("training_loss", 6).alias("training_loss"), "report_seq")


@query("h5_first_epoch_losses", _search_sql() + """
SELECT CAST(trial AS INTEGER) AS trial_id, CAST(epoch AS INTEGER) AS epoch, round(loss, 6) AS training_loss,
       CAST(seq AS BIGINT) AS report_seq FROM rep WHERE epoch = 1""")
def h5_first_epoch_losses(spark, sf_dir):
    """H5: the first reports of that search, one step of training in each."""
    return h5_trained_reports(spark, sf_dir).where("epoch = 1")


@query("h9_best_checkpoint_accuracy", _search_sql() + f""",
best AS MATERIALIZED (
  SELECT trial, epoch FROM rep r WHERE epoch = (SELECT max(epoch) FROM rep q WHERE q.trial = r.trial) ORDER BY loss, trial LIMIT 1),
pb AS MATERIALIZED (SELECT p.* FROM p2 p JOIN best b ON b.trial = p.trial AND b.epoch = 1
                    UNION ALL SELECT p.* FROM p4 p JOIN best b ON b.trial = p.trial AND b.epoch = 2)"""
       + _forward("t", "pb", "SELECT vec_id FROM ranked WHERE rnk > floor(0.7::DOUBLE * n)", len(HIDDEN) + 1) + f""",
pred AS (SELECT vec_id, idx FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY logit DESC, idx) AS o FROM tz) WHERE o = 1),
ev AS (SELECT CAST(p.idx = r.label AS BIGINT) AS hit, count(*) OVER () AS en,
              row_number() OVER (ORDER BY md5('{SEED}:eval:' || r.vec_id), r.vec_id) - 1 AS pos
       FROM pred p JOIN ranked r ON r.vec_id = p.vec_id),
padded AS (SELECT pos, hit, en FROM ev UNION ALL SELECT pos + en, hit, en FROM ev WHERE pos < ({WORKERS} - en % {WORKERS}) % {WORKERS})
SELECT CAST((SELECT trial FROM best) AS INTEGER) AS trial_id, CAST(pos % {WORKERS} AS INTEGER) AS shard,
       round(sum(hit) / CAST(max(en) // {WORKERS} AS DOUBLE), 9) AS accuracy,
       round((SELECT avg(CAST(hit AS DOUBLE)) FROM ev), 9) AS global_accuracy
FROM padded GROUP BY pos % {WORKERS}""")
def h9_best_checkpoint_accuracy(spark, sf_dir):
    """H7-H9: the best trained trial's checkpoint, loaded strictly, on shards of the test split."""
    res, test = _trained_search(spark, sf_dir)
    got = srch.evaluate_best(res, test, "vec_id", in_width=64, n_classes=10, world_size=WORKERS, batch_size=10, seed=SEED)
    return got.select("trial_id", "shard", F.round("accuracy", 9).alias("accuracy"),
                      F.round("global_accuracy", 9).alias("global_accuracy"))
