"""Data-parallel training of ReLU MLPs, one Spark job per epoch.

Layout: the train split is dealt to W shards in hash order (E6, padded),
range-partitioned so a partition holds one shard, and cached once.  An
epoch is a local sort of each partition by ``md5(seed:epoch:key)`` (no
shuffle) followed by one ``mapInArrow`` pass in which every task streams its
Arrow batches through mini-batch Adam for every model packed into the job
(carrying remainder rows across Arrow batches, so mini-batches do not depend
on Arrow batch size).  Tasks emit row-weighted parameter and moment sums;
a group-by on the parameter index averages them (``local`` mode, model
averaging).  ``sync`` mode takes exactly the steps of one-process mini-batch
training, for one model or for all trials of a search at once, over rows that lie in many
tasks: a batch of ``SHARED_ROWS`` or more is one gradient-sum job, stepped on the driver;
steps over smaller ones depend on each other and are too short for a job each, so a job takes
``RUN_ROWS`` rows of them, in one task a model.

The driver only ever holds models (checked against the broadcast limit) and
a few metric rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.functions.hashing import row_hash
from strata.operators import mlp
from strata.operators.model import (MAX_MODEL_BYTES, check_model_size, features_matrix,
                                    score, with_loss)
from strata.operators.split import shards, worker_batch_size


@dataclass
class TrainState:
    """Model + Adam state after ``epoch`` finished epochs."""

    layers: list
    params: list
    m: list
    v: list
    step: int = 0
    epoch: int = 0

    @classmethod
    def fresh(cls, layers: Sequence[int], seed: object) -> "TrainState":
        p = mlp.init_params(layers, seed)
        return cls(list(layers), p, mlp.zeros_like(p), mlp.zeros_like(p), 0, 0)


@dataclass
class ModelSpec:
    """One model packed into an epoch job (a trial of a search, or the only one)."""

    trial_id: int
    layers: list
    lr: float
    batch_size: int          # per-worker batch size
    drop_last: bool = False


@dataclass
class TrainResult:
    state: TrainState
    reports: DataFrame       # (trial_id, epoch, training_loss, report_seq)
    metrics: DataFrame | None = None  # (epoch, loss, accuracy, ...)
    params: DataFrame | None = field(default=None)


# ---------------------------------------------------------------- F6 / F7 as tables

#: Parameters per row of a partial sum: rows per task stay few, whatever the model.
CHUNK_PARAMS = 8192
#: Partial sums that one task adds; more are added in two rounds.
FAN_IN = 64


def _chunked(vec: np.ndarray) -> list[np.ndarray]:
    return [vec[a:a + CHUNK_PARAMS] for a in range(0, max(1, len(vec)), CHUNK_PARAMS)]


def _add_rows(parts: DataFrame, keys: list[str], arrays: list[str], sums: list[str],
              largest: Sequence[str] = (), sources: int | None = None) -> DataFrame:
    """Add partial rows element by element, in the order of their ``src``.

    Two rounds (by ``src // FAN_IN``, then all), so a task adds at most ``FAN_IN``
    rows of one task each, or one row per group; one round where at most ``FAN_IN``
    ``sources`` are known to emit.  The order is fixed, so sums are
    bit-identical however the shuffle delivers them."""
    schema = parts.schema
    cols = [*keys, "src", *arrays, *sums, *largest]

    def add(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("src").to_numpy(), kind="stable")
        t = t.take(pa.array(order))
        out = {c: [t.column(c)[0].as_py()] for c in [*keys, "src"]}
        for a in arrays:
            rows = [np.asarray(x.values) for x in t.column(a).combine_chunks()]
            total = rows[0].copy()
            for x in rows[1:]:
                total += x
            out[a] = [total]
        for c in sums:
            total = 0
            for x in t.column(c).to_pylist():
                total += x
            out[c] = [total]
        for c in largest:
            out[c] = [max(t.column(c).to_pylist())]
        return pa.Table.from_pydict(out, schema=to_arrow_schema(T.StructType([schema[c] for c in cols])))

    kind = T.StructType([schema[c] for c in cols])
    if sources is not None and sources <= FAN_IN:
        return parts.select(*cols).groupBy(*keys).applyInArrow(add, kind)
    first = (parts.select(*cols).withColumn("__b", F.floor(F.col("src") / FAN_IN))
             .groupBy(*keys, "__b").applyInArrow(lambda t: add(t.drop_columns("__b")), kind))
    return first.groupBy(*keys).applyInArrow(add, kind)


def _gradient_parts(df: DataFrame, params: mlp.Params, features: str, label: str):
    """Gradient sums as rows ``(chunk, src, g, loss, n)``: per task one row for
    each ``CHUNK_PARAMS`` parameters, added over all tasks.  Also the layers and
    the broadcast, for the caller to release."""
    layers = [params[0][0].shape[1]] + [w.shape[0] for w, _ in params]
    check_model_size(layers)
    bc = df.sparkSession.sparkContext.broadcast((layers, mlp.flatten(params)))

    def run(batches_):
        from pyspark import TaskContext
        lays, vec = bc.value
        ps = mlp.unflatten(vec, lays)
        total, loss, n = np.zeros(len(vec)), 0.0, 0
        for b in batches_:
            if b.num_rows == 0:
                continue
            x = features_matrix(b.column(features), b.num_rows)
            y = b.column(label).to_numpy(zero_copy_only=False).astype(np.int64)
            ls, g = mlp.loss_grad_sums(ps, x, y)
            total += mlp.flatten(g)
            loss += ls
            n += b.num_rows
        if n:
            chunks = _chunked(total)
            k = len(chunks)
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array(range(k), pa.int32()),
                "src": pa.array([TaskContext.get().partitionId()] * k, pa.int64()),
                "g": pa.array(chunks, pa.list_(pa.float64())),
                "loss": pa.array([float(loss)] * k), "n": pa.array([n] * k, pa.int64())})

    parts = df.select(features, label).mapInArrow(
        run, "chunk int, src long, g array<double>, loss double, n long")
    return _add_rows(parts, ["chunk"], ["g"], ["loss", "n"]), layers, bc


def gradient(df: DataFrame, params: mlp.Params, features: str = "features",
             label: str = "label") -> DataFrame:
    """gradient of the mean cross-entropy over all rows of ``df`` as
    ``(layer, i, j, grad)`` (bias: j = -1).  Tasks emit sums in chunks of the
    parameter vector, which are added in a tree and opened at the end."""
    parts, layers, _ = _gradient_parts(df, params, features, label)

    def rows(batches_):
        lay, ii, jj = mlp.param_index(layers)
        for b in batches_:
            for c, g, n in zip(*(b.column(x) for x in ("chunk", "g", "n"))):
                at = slice(c.as_py() * CHUNK_PARAMS, (c.as_py() + 1) * CHUNK_PARAMS)
                yield pa.RecordBatch.from_pydict({
                    "layer": lay[at].astype(np.int32), "i": ii[at].astype(np.int32),
                    "j": jj[at].astype(np.int32), "grad": np.asarray(g.values) / n.as_py()})

    return parts.select("chunk", "g", "n").mapInArrow(rows, "layer int, i int, j int, grad double")


def adam_step_table(params_df: DataFrame, grads_df: DataFrame, lr: float,
                    state_df: DataFrame | None = None, step: int = 1) -> DataFrame:
    """F7 on tables: join parameters, gradients and moments on (layer, i, j)
    and apply one Adam step; returns ``(layer, i, j, w, m, v)``."""
    b1, b2, eps = mlp.ADAM_BETA1, mlp.ADAM_BETA2, mlp.ADAM_EPS
    j = params_df.join(grads_df, ["layer", "i", "j"])
    if state_df is not None:
        j = j.join(state_df.select("layer", "i", "j", F.col("m").alias("m0"),
                                   F.col("v").alias("v0")), ["layer", "i", "j"])
    else:
        j = j.withColumn("m0", F.lit(0.0)).withColumn("v0", F.lit(0.0))
    m = F.lit(b1) * F.col("m0") + F.lit(1.0 - b1) * F.col("grad")
    v = F.lit(b2) * F.col("v0") + F.lit(1.0 - b2) * F.col("grad") * F.col("grad")
    bc1 = 1.0 - b1 ** step
    bc2 = 1.0 - b2 ** step
    j = j.withColumn("m", m).withColumn("v", v)
    denom = F.sqrt(F.col("v")) / F.lit(float(np.sqrt(bc2))) + F.lit(eps)
    return j.select("layer", "i", "j",
                    (F.col("w") - F.lit(lr / bc1) * F.col("m") / denom).alias("w"), "m", "v")


# ---------------------------------------------------------------- epoch job (local mode)

_VECTOR = T.ArrayType(T.DoubleType())
EPOCH_SCHEMA = T.StructType([
    T.StructField("trial_id", T.IntegerType()), T.StructField("chunk", T.IntegerType()),
    T.StructField("src", T.LongType()), T.StructField("wn", _VECTOR),
    T.StructField("mn", _VECTOR), T.StructField("vn", _VECTOR), T.StructField("n", T.LongType()),
    T.StructField("loss_sum", T.DoubleType()), T.StructField("steps_total", T.LongType()),
    T.StructField("steps", T.LongType())])


class _Runner:
    """Streams rows of one shard through mini-batch Adam for one model."""

    def __init__(self, spec, state_vecs):
        self.spec = spec
        lays = spec["layers"]
        self.lays = lays
        p, m, v, step = state_vecs
        self.p = mlp.unflatten(p, lays)
        self.m = mlp.unflatten(m, lays)
        self.v = mlp.unflatten(v, lays)
        self.step = step
        self.bx: list = []
        self.by: list = []
        self.buffered = 0
        self.loss_sum = 0.0
        self.steps = 0
        self.rows = 0

    def _train(self, x, y):
        ls, g = mlp.loss_grad_sums(self.p, x, y)
        g = [(gw / len(y), gb / len(y)) for gw, gb in g]
        self.step += 1
        self.p, self.m, self.v = mlp.adam_update(self.p, g, self.m, self.v, self.step,
                                                 self.spec["lr"])
        self.loss_sum += ls / len(y)
        self.steps += 1

    def feed(self, x, y):
        self.rows += len(y)
        bs = self.spec["batch_size"]
        if self.buffered:
            x = np.concatenate(self.bx + [x])
            y = np.concatenate(self.by + [y])
            self.bx, self.by, self.buffered = [], [], 0
        full = (len(y) // bs) * bs
        for s in range(0, full, bs):
            self._train(x[s:s + bs], y[s:s + bs])
        if full < len(y):
            self.bx, self.by, self.buffered = [x[full:]], [y[full:]], len(y) - full

    def flush(self):
        if self.buffered and not self.spec["drop_last"]:
            self._train(np.concatenate(self.bx), np.concatenate(self.by))

    def finish(self, trial_id, shard):
        self.flush()
        n = self.rows
        p, m, v = (_chunked(mlp.flatten(t) * n) for t in (self.p, self.m, self.v))
        k = len(p)
        return pa.RecordBatch.from_pydict({
            "trial_id": [trial_id] * k, "chunk": list(range(k)), "src": [shard] * k,
            "wn": p, "mn": m, "vn": v, "n": [n] * k, "loss_sum": [float(self.loss_sum)] * k,
            "steps_total": [self.steps] * k, "steps": [self.step] * k},
            schema=to_arrow_schema(EPOCH_SCHEMA))


def _epoch_job(sorted_df: DataFrame, specs: list[ModelSpec], states: dict, features: str,
               label: str) -> DataFrame:
    """One pass: each task trains every packed model on its shard(s)."""
    sc = sorted_df.sparkSession.sparkContext
    payload = {
        s.trial_id: ({"layers": list(s.layers), "lr": s.lr, "batch_size": s.batch_size,
                      "drop_last": s.drop_last},
                     (mlp.flatten(states[s.trial_id].params), mlp.flatten(states[s.trial_id].m),
                      mlp.flatten(states[s.trial_id].v), states[s.trial_id].step))
        for s in specs}
    bc = sc.broadcast(payload)

    def run(batches_):
        pl = bc.value
        runners = None
        cur = None
        for b in batches_:
            if b.num_rows == 0:
                continue
            shard = b.column("shard").to_numpy(zero_copy_only=False)
            x_all = features_matrix(b.column(features), b.num_rows)
            y_all = b.column(label).to_numpy(zero_copy_only=False).astype(np.int64)
            # rows arrive sorted by shard; split the batch at shard changes
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(shard)]):
                if cur is None or shard[lo] != cur:
                    if runners is not None:
                        for t, r in runners.items():
                            yield r.finish(t, int(cur))
                    cur = shard[lo]
                    runners = {t: _Runner(spec, vecs) for t, (spec, vecs) in pl.items()}
                for r in runners.values():
                    r.feed(x_all[lo:hi], y_all[lo:hi])
        if runners is not None:
            for t, r in runners.items():
                yield r.finish(t, int(cur))

    return sorted_df.select("shard", features, label).mapInArrow(run, EPOCH_SCHEMA), bc


def _average(parts: DataFrame, specs: list[ModelSpec], states: dict, epoch: int):
    """Row-weighted average per model; returns new states and (loss, steps).

    A shard contributes one row per ``CHUNK_PARAMS`` parameters; rows are added
    in shard order, so the average is bit-for-bit the same whatever order the
    shuffle delivers them in."""
    got: dict = {}
    for r in _add_rows(parts, ["trial_id", "chunk"], ["wn", "mn", "vn"],
                       ["n", "loss_sum", "steps_total"], ["steps"]).toArrow().to_pylist():
        got.setdefault(r["trial_id"], {})[r["chunk"]] = r
    out = {}
    for s in specs:
        rows = [got[s.trial_id][c] for c in sorted(got[s.trial_id])]
        n, steps = float(rows[0]["n"]), rows[0]["steps_total"]
        p, m, v = (np.concatenate([r[c] for r in rows]) / n for c in ("wn", "mn", "vn"))
        new = TrainState(list(s.layers), mlp.unflatten(p, s.layers), mlp.unflatten(m, s.layers),
                         mlp.unflatten(v, s.layers), int(rows[0]["steps"]), epoch + 1)
        out[s.trial_id] = (new, rows[0]["loss_sum"] / steps if steps else float("nan"), steps)
    return out


def packs(specs: list[ModelSpec]) -> list[list[ModelSpec]]:
    """Models per job: as many as fit the broadcast limit (parameters and both moments)."""
    out, room = [], 0
    for s in specs:
        size = mlp.n_params(s.layers) * 3 * 8
        if not out or size > room:
            out.append([])
            room = MAX_MODEL_BYTES
        out[-1].append(s)
        room -= size
    return out


def shard_table(train_df: DataFrame, key: str, world_size: int, seed: object,
                features: str = "features", label: str = "label") -> DataFrame:
    """E6 + physical layout: one shard per partition, cached (MEMORY_AND_DISK).
    Recomputation after an executor loss gives the same rows (hash order)."""
    sh = shards(train_df.select(key, features, label), key, world_size, seed, pad=True)
    laid = sh.select(key, features, label, "shard", "local_pos").repartitionById(
        world_size, F.col("shard"))
    return laid.persist(StorageLevel.MEMORY_AND_DISK)


def epoch_sorted(base: DataFrame, key: str, seed: object, epoch: int, shuffle: bool = True
                 ) -> DataFrame:
    """E3 inside each shard: a partition-local sort, no exchange."""
    if shuffle:
        return base.sortWithinPartitions("shard", row_hash(key, seed, epoch), key)
    return base.sortWithinPartitions("shard", "local_pos")


def run_epochs(base: DataFrame, key: str, specs: list[ModelSpec], states: dict, seed: object,
               n_epochs: int, features: str = "features", label: str = "label",
               shuffle: bool = True, on_epoch=None) -> dict:
    """Train packed models for ``n_epochs`` more epochs (local mode).

    ``on_epoch(epoch, results) -> list[trial_id] | None`` may stop models
    (early stopping); it receives ``{trial_id: (state, loss, steps)}``."""
    live = list(specs)
    for _ in range(n_epochs):
        if not live:
            break
        epoch = states[live[0].trial_id].epoch
        res = {}
        for pack in packs(live):           # one pass over the data per pack
            parts, bc = _epoch_job(epoch_sorted(base, key, seed, epoch, shuffle), pack, states,
                                   features, label)
            res |= _average(parts, pack, states, epoch)
            bc.destroy()
        for t, (st, _, _) in res.items():
            states[t] = st
        stop = on_epoch(epoch, res) if on_epoch else None
        if stop:
            live = [s for s in live if s.trial_id not in set(stop)]
    return states


# ---------------------------------------------------------------- sync mode

#: Rows of a batch that one task takes at least, and rows of a cached partition.
SLICE_ROWS, PART_ROWS = 64, 65_536
#: Rows of a batch from which its gradient is summed by many tasks; rows of smaller
#: batches that one job takes the steps of.
SHARED_ROWS, RUN_ROWS = 4_096, 65_536


@dataclass
class SpreadTable:
    """Rows by position in the (padded) order of an epoch, cached; each batch lies
    in ``slices`` partitions, so as many tasks share its gradient."""

    rows: DataFrame
    n: int                   # positions
    parts: int               # partitions


def spread_table(train_df: DataFrame, key: str, world_size: int, seed: object, epoch: int | None,
                 batch_rows: int, features: str = "features", label: str = "label",
                 n: int | None = None) -> SpreadTable:
    """E3 + E6 for steps shared by many tasks.  ``epoch=None``: one fixed order.

    Position p lies in slice ``p mod slices`` of its block of consecutive positions
    (a partition holds at most ``PART_ROWS``), sorted by position: a step reads only the
    cached batches of its positions."""
    n = train_df.count() if n is None else n
    padded = n + (-n) % world_size
    cores = train_df.sparkSession.sparkContext.defaultParallelism
    slices = max(1, min(cores, batch_rows // SLICE_ROWS))
    blocks = max(1, -(-padded // (slices * PART_ROWS)))
    salt = () if epoch is None else (epoch,)
    sh = shards(train_df.select(key, features, label), key, world_size, seed, *salt, n=n)
    part = (F.floor(F.col("pos") / (slices * PART_ROWS)) * slices + F.col("pos") % slices).cast("int")
    laid = (sh.select(features, label, "pos", part.alias("__part")).repartitionById(blocks * slices, F.col("__part"))
            .sortWithinPartitions("pos").drop("__part").persist(StorageLevel.MEMORY_AND_DISK))
    return SpreadTable(laid, padded, blocks * slices)


def _step_sums(table: SpreadTable, models: dict, features: str, label: str) -> dict:
    """Gradient and loss sums of one step of several models, each over its own
    positions: ``models[t] = (layers, flat parameters, first, end)``.  One job."""
    sc = table.rows.sparkSession.sparkContext
    bc = sc.broadcast(models)
    within = None
    for lo, hi in sorted({m[2:] for m in models.values()}):
        cond = (F.col("pos") >= lo) & (F.col("pos") < hi)
        within = cond if within is None else within | cond

    def run(batches_):
        from pyspark import TaskContext
        sums = {}
        for b in batches_:
            if b.num_rows == 0:
                continue
            x = features_matrix(b.column(features), b.num_rows)
            y = b.column(label).to_numpy(zero_copy_only=False).astype(np.int64)
            pos = b.column("pos").to_numpy()
            for t, (lays, vec, lo, hi) in bc.value.items():
                on = (pos >= lo) & (pos < hi)
                if on.any():
                    ls, g = mlp.loss_grad_sums(mlp.unflatten(vec, lays), x[on], y[on])
                    was = sums.get(t, (0.0, 0.0, 0))
                    sums[t] = (was[0] + mlp.flatten(g), was[1] + ls, was[2] + int(on.sum()))
        for t, (g, ls, k) in sums.items():
            chunks = _chunked(g)
            m = len(chunks)
            yield pa.RecordBatch.from_pydict({
                "trial_id": pa.array([t] * m, pa.int32()), "chunk": pa.array(range(m), pa.int32()),
                "src": pa.array([TaskContext.get().partitionId()] * m, pa.int64()),
                "g": pa.array(chunks, pa.list_(pa.float64())),
                "loss": pa.array([float(ls)] * m), "n": pa.array([k] * m, pa.int64())})

    parts = table.rows.where(within).mapInArrow(
        run, "trial_id int, chunk int, src long, g array<double>, loss double, n long")
    rows = _add_rows(parts, ["trial_id", "chunk"], ["g"], ["loss", "n"], sources=table.parts).toArrow().to_pylist()
    bc.destroy()
    out = {}
    for r in sorted(rows, key=lambda r: (r["trial_id"], r["chunk"])):
        out.setdefault(r["trial_id"], []).append(r)
    return {t: (np.concatenate([r["g"] for r in rs]) / rs[0]["n"], rs[0]["loss"] / rs[0]["n"]) for t, rs in out.items()}


RUN_SCHEMA = ("trial_id int, chunk int, w array<double>, m array<double>, v array<double>, "
              "loss double, steps long")


def _step_runs(table: SpreadTable, pack: list[ModelSpec], now: dict, spans: dict, features: str, label: str) -> dict:
    """Steps of several models over consecutive batches, each over its own positions:
    ``spans[t] = (batch rows, first, end)``.  One job: the tasks that hold the rows deal them to
    one task a model, which takes the steps as the rows arrive in order.

    Returns ``{trial_id: (state, sum of the losses before each step)}``."""
    sc = table.rows.sparkSession.sparkContext
    bc = sc.broadcast([(s.trial_id, {"layers": list(s.layers), "lr": s.lr, "batch_size": spans[s.trial_id][0],
                                     "drop_last": False},
                        (*(mlp.flatten(x) for x in (now[s.trial_id].params, now[s.trial_id].m, now[s.trial_id].v)),
                         now[s.trial_id].step)) for s in pack])
    mine = [(F.col("pos") >= lo) & (F.col("pos") < hi) for _, lo, hi in (spans[s.trial_id] for s in pack)]
    models = F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(mine)]))
    within = mine[0]
    for c in mine[1:]:
        within = within | c

    def run(batches_):
        runner = which = None
        for b in batches_:
            if b.num_rows == 0:
                continue
            if runner is None:
                which, spec, vecs = bc.value[b.column("__model")[0].as_py()]
                runner = _Runner(spec, vecs)
            runner.feed(features_matrix(b.column(features), b.num_rows),
                        b.column(label).to_numpy(zero_copy_only=False).astype(np.int64))
        if runner is not None:
            runner.flush()
            for c, (w, m, v) in enumerate(zip(*(_chunked(mlp.flatten(x)) for x in (runner.p, runner.m, runner.v)))):
                yield pa.RecordBatch.from_pydict({
                    "trial_id": pa.array([which], pa.int32()), "chunk": pa.array([c], pa.int32()),
                    "w": pa.array([w], pa.list_(pa.float64())), "m": pa.array([m], pa.list_(pa.float64())),
                    "v": pa.array([v], pa.list_(pa.float64())), "loss": pa.array([float(runner.loss_sum)]),
                    "steps": pa.array([runner.steps], pa.int64())})

    dealt = (table.rows.where(within).select(features, label, "pos", F.explode(models).alias("__model"))
             .repartitionById(len(pack), F.col("__model")).sortWithinPartitions("pos"))
    got: dict = {}
    for r in dealt.mapInArrow(run, RUN_SCHEMA).toArrow().to_pylist():
        got.setdefault(r["trial_id"], {})[r["chunk"]] = r
    bc.destroy()
    out = {}
    for s in pack:
        st, rows = now[s.trial_id], [got[s.trial_id][c] for c in sorted(got[s.trial_id])]
        p, m, v = (mlp.unflatten(np.concatenate([r[c] for r in rows]), st.layers) for c in "wmv")
        out[s.trial_id] = (TrainState(st.layers, p, m, v, st.step + rows[0]["steps"], st.epoch), rows[0]["loss"])
    return out


def spread_epoch(table: SpreadTable, specs: list[ModelSpec], states: dict, world_size: int = 1,
                 features: str = "features", label: str = "label") -> dict:
    """One epoch of exact mini-batch Adam for packed models.  Step b of a model covers the
    positions ``b * batch`` and on, which is batch b of each of its ``world_size`` shards;
    their mean gradient is the mean over those rows.

    Batches of ``SHARED_ROWS`` or more: per step one job sums the gradients of every such
    model's batch over all tasks, and the steps are taken on the driver.  Smaller ones: one
    job for every ``RUN_ROWS`` rows (``_step_runs``), so the number of jobs does not grow as the
    number of steps.

    Returns ``{trial_id: (state, mean loss before each step, steps)}``."""
    per = {s.trial_id: s.batch_size * world_size for s in specs}
    steps = {s.trial_id: table.n // per[s.trial_id] if s.drop_last else -(-table.n // per[s.trial_id]) for s in specs}
    now = {s.trial_id: states[s.trial_id] for s in specs}
    losses = dict.fromkeys(now, 0.0)
    short = [s for s in specs if per[s.trial_id] < SHARED_ROWS]
    run = {s.trial_id: max(1, RUN_ROWS // per[s.trial_id]) for s in short}
    for r in range(max((-(-steps[t] // k) for t, k in run.items()), default=0)):
        for pack in packs([s for s in short if r * run[s.trial_id] < steps[s.trial_id]]):
            spans = {t: (per[t], r * run[t] * per[t], min(table.n, min(steps[t], (r + 1) * run[t]) * per[t]))
                     for t in (s.trial_id for s in pack)}
            for t, (st, loss) in _step_runs(table, pack, now, spans, features, label).items():
                now[t] = st
                losses[t] += loss
    shared = [s for s in specs if per[s.trial_id] >= SHARED_ROWS]
    for b in range(max((steps[s.trial_id] for s in shared), default=0)):
        for pack in packs([s for s in shared if b < steps[s.trial_id]]):
            models = {s.trial_id: (list(s.layers), mlp.flatten(now[s.trial_id].params),
                                   b * per[s.trial_id], min(table.n, (b + 1) * per[s.trial_id])) for s in pack}
            got = _step_sums(table, models, features, label)
            for s in pack:
                t, st = s.trial_id, now[s.trial_id]
                g, loss = got[t]
                losses[t] += loss
                p, m, v = mlp.adam_update(st.params, mlp.unflatten(g, st.layers), st.m, st.v, st.step + 1, s.lr)
                now[t] = TrainState(st.layers, p, m, v, st.step + 1, st.epoch)
    return {t: (TrainState(st.layers, st.params, st.m, st.v, st.step, st.epoch + 1),
                losses[t] / max(1, steps[t]), steps[t]) for t, st in now.items()}


# ---------------------------------------------------------------- F10

def evaluate(eval_base: DataFrame, state: TrainState, n_rows: int, world_size: int,
             features: str = "features", label: str = "label") -> dict:
    """G3/G4 on a sharded, batched eval table (columns shard, batch_id, pos)."""
    sc = with_loss(score(eval_base, state.params, features,
                         keep=[label, "shard", "batch_id", "pos"]), label)
    sc = sc.withColumn("hit", (F.col("prediction") == F.col(label)).cast("double"))
    size = n_rows // world_size
    per_shard = sc.groupBy("shard", "batch_id").agg(
        F.avg("loss").alias("bl"), F.sum("hit").alias("c"), F.count(F.lit(1)).alias("k"),
        F.sum(F.when(F.col("pos") < n_rows, F.col("hit"))).alias("cu"),
        F.sum(F.when(F.col("pos") < n_rows, F.col("loss"))).alias("lu"),
        F.sum((F.col("pos") < n_rows).cast("long")).alias("ku"))
    rows = per_shard.groupBy("shard").agg(
        F.avg("bl").alias("loss"), F.sum("c").alias("correct"), F.sum("cu").alias("cu"),
        F.sum("lu").alias("lu"), F.sum("ku").alias("ku")).collect()
    shard_loss = {r["shard"]: r["loss"] for r in rows}
    shard_acc = {r["shard"]: r["correct"] / size if size else float("nan") for r in rows}
    tot = sum(r["ku"] for r in rows)
    return {"loss": sum(shard_loss.values()) / len(rows),
            "accuracy": sum(r["cu"] for r in rows) / tot,
            "row_loss": sum(r["lu"] for r in rows) / tot,
            "shard_loss": shard_loss, "shard_accuracy": shard_acc}


def eval_table(eval_df: DataFrame, key: str, world_size: int, batch_size: int, seed: object,
               features: str = "features", label: str = "label") -> tuple[DataFrame, int]:
    """The eval split dealt to shards (padded) with per-worker batch ids, cached."""
    sh, n = shards(eval_df.select(key, features, label), key, world_size, seed, "eval",
                   pad=True, with_count=True)
    sh = sh.withColumn("batch_id", F.floor(F.col("local_pos") / batch_size).cast("long"))
    return sh.persist(StorageLevel.MEMORY_AND_DISK), n


def train_mlp(train_df: DataFrame, key: str, layers: Sequence[int], *, lr: float = 1e-3,
              batch_size: int = 32, epochs: int = 1, world_size: int = 1, seed: object = 0,
              mode: str = "local", shuffle: bool = True, drop_last: bool = False,
              eval_df: DataFrame | None = None, init: TrainState | None = None,
              features: str = "features", label: str = "label", trial_id: int = 0,
              checkpoint_path: str | None = None) -> TrainResult:
    """train a ReLU MLP on ``(key, features, label)`` rows.

    ``batch_size`` is global; each of ``world_size`` workers uses
    ``batch_size // world_size`` (E7).  ``init`` resumes from a state (F11):
    epochs are numbered on, so a resumed run equals an uninterrupted one."""
    spark = train_df.sparkSession
    check_model_size(layers, 3)
    state = init if init is not None else TrainState.fresh(layers, seed)
    if list(state.layers) != list(layers):
        raise ValueError(f"state has layers {state.layers}, asked for {list(layers)}")
    wbs = worker_batch_size(batch_size, world_size)
    reports, metrics = [], []
    ev = None
    if eval_df is not None:
        ev, n_eval = eval_table(eval_df, key, world_size, wbs, seed, features, label)
    base = table = None
    spec = ModelSpec(trial_id, list(layers), lr, wbs, drop_last)
    if mode == "local":
        base = shard_table(train_df, key, world_size, seed, features, label)
    elif mode == "sync":
        n_train = train_df.count()
        if not shuffle:
            table = spread_table(train_df, key, world_size, seed, None, batch_size, features, label, n_train)
    else:
        raise ValueError("mode is 'local' or 'sync'")
    try:
        for _ in range(epochs):
            ep = state.epoch
            if mode == "local":
                states = {trial_id: state}
                holder = {}

                def keep(e, res):
                    holder.update(res)
                run_epochs(base, key, [spec], states, seed, 1, features, label, shuffle, keep)
                state, loss, _ = holder[trial_id]
            else:
                if shuffle:
                    table = spread_table(train_df, key, world_size, seed, ep, batch_size, features, label, n_train)
                state, loss, _ = spread_epoch(table, [spec], {trial_id: state}, world_size, features, label)[trial_id]
                if shuffle:
                    table.rows.unpersist()
            reports.append((trial_id, ep + 1, float(loss), ep))
            if checkpoint_path:
                write_checkpoint(spark, checkpoint_path, trial_id, state)
            if ev is not None:
                r = evaluate(ev, state, n_eval, world_size, features, label)
                metrics.append((ep, r["loss"], r["accuracy"], r["row_loss"]))
    finally:
        if base is not None:
            base.unpersist()
        if table is not None:
            table.rows.unpersist()
        if ev is not None:
            ev.unpersist()
    rep_df = spark.createDataFrame(
        reports, "trial_id int, epoch int, training_loss double, report_seq long")
    met_df = (spark.createDataFrame(metrics, "epoch int, loss double, accuracy double, "
                                    "row_loss double") if eval_df is not None else None)
    return TrainResult(state, rep_df, met_df)


# ---------------------------------------------------------------- A3 / A4

def write_checkpoint(spark: SparkSession, path: str, trial_id: int, state: TrainState) -> None:
    """A4: parameters and Adam state of one epoch as Parquet, partitioned by
    trial and epoch (a rerun of the same epoch overwrites only its folder)."""
    write_checkpoints(spark, path, {trial_id: state})


CHECKPOINT_SCHEMA = ("trial_id int, epoch int, chunk int, layers array<int>, step long, "
                     "w array<double>, m array<double>, v array<double>")


def write_checkpoints(spark: SparkSession, path: str, states: dict) -> None:
    """A4 for several trials at once: one write job per epoch, a row for each
    ``CHUNK_PARAMS`` parameters (``checkpoint_rows`` opens them)."""
    rows = [(int(t), int(st.epoch), c, [int(x) for x in st.layers], int(st.step), w.tolist(), m.tolist(), v.tolist())
            for t, st in states.items()
            for c, (w, m, v) in enumerate(zip(*(_chunked(mlp.flatten(x)) for x in (st.params, st.m, st.v))))]
    if not rows:
        return
    schema = to_arrow_schema(T._parse_datatype_string(CHECKPOINT_SCHEMA))
    table = pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    (spark.createDataFrame(table).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("trial_id", "epoch").parquet(path))


def checkpoint_rows(blocks: DataFrame) -> DataFrame:
    """Blocks of checkpoints opened on the executors: ``trial_id, epoch, step, layer,
    i, j, w, m, v``, a row a parameter (bias: j = -1)."""
    def run(batches_):
        for b in batches_:
            for r in b.to_pylist():
                lay, ii, jj = mlp.param_index(r["layers"])
                at = slice(r["chunk"] * CHUNK_PARAMS, r["chunk"] * CHUNK_PARAMS + len(r["w"]))
                k = len(r["w"])
                yield pa.RecordBatch.from_pydict({
                    "trial_id": pa.array([r["trial_id"]] * k, pa.int32()), "epoch": pa.array([r["epoch"]] * k, pa.int32()),
                    "step": pa.array([r["step"]] * k, pa.int64()), "layer": lay[at].astype(np.int32),
                    "i": ii[at].astype(np.int32), "j": jj[at].astype(np.int32),
                    "w": np.array(r["w"]), "m": np.array(r["m"]), "v": np.array(r["v"])})

    return blocks.mapInArrow(run, "trial_id int, epoch int, step long, layer int, i int, j int, w double, m double, v double")


def read_checkpoint(spark: SparkSession, path: str, trial_id: int, layers: Sequence[int],
                    epoch: int | None = None) -> TrainState:
    """A3: load the state of a trial (latest epoch unless given).  Strict:
    other layers, a missing, repeated or misshapen block raise (Q8); no checkpoint raises (Q12)."""
    check_model_size(layers, 3)
    df = spark.read.parquet(path).filter(F.col("trial_id") == trial_id)
    if epoch is None:
        epoch = df.agg(F.max("epoch")).first()[0]
        if epoch is None:
            raise FileNotFoundError(f"no checkpoint for trial {trial_id} under {path}")
    rows = df.filter(F.col("epoch") == epoch).select("chunk", "layers", "step", "w", "m", "v").orderBy("chunk").collect()
    if not rows:
        raise FileNotFoundError(f"no checkpoint for trial {trial_id} epoch {epoch}")
    if any(list(r["layers"]) != list(layers) for r in rows):
        raise ValueError(f"checkpoint has layers {rows[0]['layers']}, asked for {list(layers)}")
    want = [len(c) for c in _chunked(np.empty(mlp.n_params(layers)))]
    if [r["chunk"] for r in rows] != list(range(len(want))) or any([len(r[c]) for r in rows] != want for c in "wmv"):
        raise ValueError("missing, repeated or misshapen parameters")
    if len({r["step"] for r in rows}) != 1:
        raise ValueError("blocks of different steps")
    p, m, v = (mlp.unflatten(np.concatenate([r[c] for r in rows]), layers) for c in "wmv")
    return TrainState(list(layers), p, m, v, int(rows[0]["step"]), int(epoch))


# ---------------------------------------------------------------- U1

def map_shards(df: DataFrame, fn, schema, world_size: int, shard_col: str = "shard"
               ) -> DataFrame:
    """Run a user function on each shard's rows (pandas batches in,
    pandas out); all rows of a shard are in one partition, in shard order."""
    return (df.repartitionById(world_size, F.col(shard_col)).sortWithinPartitions(shard_col)
            .mapInPandas(fn, schema))
