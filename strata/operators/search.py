"""H1-H9: hyper-parameter search as table operators.

* draws (H1-H3, U3): ``u -> Column`` functions of a uniform ``u`` that is
  ``md5("<seed>:<trial>:<param>")``; any Column expression of ``u`` is a
  user-defined draw;
* trials table (H4): ``spark.range`` (or any table of trial ids) + draws;
* search (H5): one training job per epoch for all live trials with the same
  world size, reports appended per epoch, early stopping between epochs;
* successive halving (H6, ASHA stopping rule): ``asha_prune`` over a
  reports table, quantiles block by block;
* best trial (H7), its config and checkpoint (H8), its test figures (H9).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.hashing import uniform_of
from strata.operators.prefix import prefix_quantile
from strata.session import mark, marks

Draw = Callable[[Column], Column]


# ---------------------------------------------------------------- H1-H3

def choice(values: Sequence) -> Draw:
    """H1: uniform pick from a list."""
    vals = list(values)
    return lambda u: F.element_at(F.array(*[F.lit(v) for v in vals]),
                                  (F.floor(u * F.lit(len(vals))) + 1).cast("int"))


def pow2_randint(lo: int, hi: int) -> Draw:
    """H2: ``2 ** randint(lo, hi)`` with ``hi`` exclusive."""
    return lambda u: F.pow(F.lit(2.0), F.lit(lo) + F.floor(u * F.lit(hi - lo))).cast("int")


def randint(lo: int, hi: int) -> Draw:
    return lambda u: (F.lit(lo) + F.floor(u * F.lit(hi - lo))).cast("int")


def loguniform(lo: float, hi: float) -> Draw:
    """H3: log-uniform in [lo, hi)."""
    a, b = math.log(lo), math.log(hi)
    return lambda u: F.exp(F.lit(a) + u * F.lit(b - a))


def uniform_range(lo: float, hi: float) -> Draw:
    return lambda u: F.lit(lo) + u * F.lit(hi - lo)


def draw_u(seed: object, trial: Column, param: str) -> Column:
    return uniform_of(F.concat(F.lit(f"{seed}:"), trial.cast("string"), F.lit(f":{param}")))


# ---------------------------------------------------------------- H4

def trials_from_ids(ids: DataFrame, id_col: str, space: dict[str, Draw], seed: object,
                    config_cols: Sequence[str] | None = None) -> DataFrame:
    """H4 over any table of trial ids: one draw per (trial, parameter).
    ``config_cols`` go into the ``config`` struct, the rest stay top-level."""
    t = F.col(id_col)
    drawn = {name: d(draw_u(seed, t, name)) for name, d in space.items()}
    cfg = list(space) if config_cols is None else list(config_cols)
    cols = [t.cast("int").alias("trial_id"),
            F.struct(*[drawn[c].alias(c) for c in cfg]).alias("config")]
    cols += [drawn[c].alias(c) for c in space if c not in cfg]
    return ids.select(*cols)


def make_trials(spark: SparkSession, num_samples: int, space: dict[str, Draw], seed: object,
                config_cols: Sequence[str] | None = None) -> DataFrame:
    """H4: ``num_samples`` trials numbered 0..n-1."""
    return trials_from_ids(spark.range(num_samples), "id", space, seed, config_cols)


def reference_space(batch_sizes=(20, 40, 60, 80), workers=(1, 2)) -> dict[str, Draw]:
    """The search space of the binary-classifier search: batch size from a
    list, hidden widths 2^[6,10), 2^[5,9), 2^[3,7), log-uniform learning rate
    in [1e-4, 1e-1], 1 or 2 workers."""
    # fixed values: these ranges define the search
    return {
        "batch_size": choice(list(batch_sizes)),
        "l1": pow2_randint(6, 10),
        "l2": pow2_randint(5, 9),
        "l3": pow2_randint(3, 7),
        "lr": loguniform(1e-4, 1e-1),
        "num_workers": choice(list(workers)),
    }


# ---------------------------------------------------------------- H6

def rung_milestones(max_t: int, grace_period: int = 1, reduction_factor: float = 2) -> list[int]:
    """Milestones ``grace * rf**k < max_t`` (ascending)."""
    n = int(math.log(max_t / grace_period) / math.log(reduction_factor) + 1)
    return sorted(int(grace_period * reduction_factor ** k) for k in range(n)
                  if grace_period * reduction_factor ** k < max_t)


def _rung_of(epoch: Column, milestones: list[int]) -> Column:
    """Largest milestone <= epoch (null below the first)."""
    out = F.lit(None).cast("int")
    for m in milestones:
        out = F.when(epoch >= F.lit(m), F.lit(m)).otherwise(out)
    return out


def asha_prune(reports: DataFrame, max_t: int, grace_period: int = 1,
               reduction_factor: float = 2, metric: str = "training_loss",
               mode: str = "min") -> DataFrame:
    """H6: early-stopping decisions of asynchronous successive halving.

    ``reports(trial_id, epoch, <metric>, report_seq)``, ``epoch`` counting
    reports from 1.  At its first report at or past a milestone m a trial
    is compared with the reports recorded earlier (in ``report_seq`` order)
    at m: it stops if its metric is worse than their ``1/rf`` quantile
    (linear interpolation).  A stopped trial takes no part in later rungs.

    Returns ``(trial_id, rung, epoch, <metric>, report_seq, cutoff, stop)``.
    The quantile of earlier reports is found block by block (``prefix_quantile``), so a
    rung may hold any number of trials; the first-report lookup is a group-by
    (map-side partial aggregation)."""
    ms = rung_milestones(max_t, grace_period, reduction_factor)
    q = 1.0 / reduction_factor if mode == "min" else 1.0 - 1.0 / reduction_factor
    r = (reports.filter(F.col("epoch") < F.lit(max_t))
         .withColumn("rung", _rung_of(F.col("epoch"), ms))
         .filter(F.col("rung").isNotNull()))
    first = (r.groupBy("trial_id", "rung")
             .agg(F.min(F.struct("report_seq", "epoch", metric)).alias("f"))
             .select("trial_id", "rung", "f.epoch", F.col(f"f.{metric}").alias(metric),
                     "f.report_seq"))
    # one row per (trial, rung): read by every rung below, so written once
    first = _checkpoint(first)
    sizes = {r["rung"]: r["count"] for r in first.groupBy("rung").count().collect()}
    stopped = None
    outs = []
    for pos, m in enumerate(ms):
        cand = first.filter(F.col("rung") == m)
        if stopped is not None:
            cand = cand.join(stopped, "trial_id", "left_anti")
        dec = prefix_quantile(cand, "report_seq", metric, q, "cutoff", n=sizes.get(m, 0))
        worse = (F.col(metric) > F.col("cutoff")) if mode == "min" else \
            (F.col(metric) < F.col("cutoff"))
        dec = dec.withColumn("stop", F.coalesce(worse, F.lit(False)).cast("int"))
        # decisions of this rung feed every later one: write the (small)
        # table to the shared checkpoint folder so plans stay linear in rungs
        if pos < len(ms) - 1:
            dec = _checkpoint(dec)
        outs.append(dec)
        s = dec.filter(F.col("stop") == 1).select("trial_id")
        stopped = s if stopped is None else stopped.unionByName(s)
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out.select("trial_id", "rung", "epoch", metric, "report_seq", "cutoff", "stop")


def _checkpoint(df: DataFrame) -> DataFrame:
    from strata.session import materialize
    return materialize(df, "asha")


class AshaRule:
    """The same rule applied online to reports as they arrive (search loop)."""

    def __init__(self, max_t: int, grace_period: int = 1, reduction_factor: float = 2,
                 mode: str = "min"):
        if mode not in ("min", "max"):
            raise ValueError("mode is 'min' or 'max'")
        self.max_t = max_t
        self.rf = reduction_factor
        self.mode = mode
        self.milestones = rung_milestones(max_t, grace_period, reduction_factor)
        self.recorded: dict[int, dict[int, float]] = {m: {} for m in self.milestones}

    def on_report(self, trial_id: int, epoch: int, value: float) -> bool:
        """True to continue, False to stop."""
        if epoch >= self.max_t:
            return False
        rungs = [m for m in self.milestones if m <= epoch]
        if not rungs:
            return True
        m = rungs[-1]
        rec = self.recorded[m]
        if trial_id in rec:
            return True
        keep = True
        if rec:
            q = 100.0 / self.rf if self.mode == "min" else 100.0 * (1.0 - 1.0 / self.rf)
            cutoff = float(np.percentile(list(rec.values()), q))
            keep = not (value > cutoff if self.mode == "min" else value < cutoff)
        rec[trial_id] = value
        return keep


# ---------------------------------------------------------------- H7 / H8

def best_trial(reports: DataFrame, metric: str = "training_loss", mode: str = "min"
               ) -> DataFrame:
    """H7: each trial's last report, then the best one (ties by trial id).
    The limit is the feature (top-1)."""
    last = reports.groupBy("trial_id").agg(
        F.max_by(F.struct("epoch", metric), "epoch").alias("l")).select(
        "trial_id", "l.epoch", F.col(f"l.{metric}").alias(metric))
    order = F.col(metric).asc() if mode == "min" else F.col(metric).desc()
    return last.orderBy(order, "trial_id").limit(1)


def best_config(best: DataFrame, trials: DataFrame) -> DataFrame:
    """H8: the best trial's row of the trials table."""
    return best.join(trials, "trial_id")


# ---------------------------------------------------------------- H5 / H9

@dataclass
class SearchResult:
    trials: DataFrame
    reports: DataFrame
    decisions: list
    checkpoint_path: str


def run_search(train_df: DataFrame, key: str, trials: DataFrame, *, in_width: int,
               n_classes: int, max_epochs: int, grace_period: int = 1,
               reduction_factor: float = 2, seed: object = 0, checkpoint_path: str,
               features: str = "features", label: str = "label",
               resume: bool = False, shuffle: bool = True, mode: str = "local") -> SearchResult:
    """H5: train every trial, one job per epoch for all live trials of one
    world size (more only past the broadcast limit), with ASHA
    early stopping between epochs.  Every epoch writes the state of every live trial
    (A4) to ``<checkpoint_path>/state``, its reports (A5) to a folder of
    ``<checkpoint_path>/reports``, and then a mark in ``<checkpoint_path>/done``: an
    epoch without its mark did not happen, and is written over; with ``resume`` a restarted search
    replays the reports through the stopping rule, reloads each live trial's
    last state strictly (A3, F11) and carries on, giving the same reports as
    an uninterrupted run.  The trials table (one row per trial) and the
    reports (one row per trial and epoch) are read on the driver; the data
    never is.

    ``mode="local"`` trains a trial's shards in one task each; ``mode="sync"`` takes
    every trial's exact mini-batch steps over rows in many tasks."""
    if mode not in ("local", "sync"):
        raise ValueError("mode is 'local' or 'sync'")
    from strata.operators import train as tr
    from strata.sources.reports import read_reports
    spark = train_df.sparkSession
    state_path, reports_path = f"{checkpoint_path}/state", f"{checkpoint_path}/reports"
    rows = trials.select("trial_id", "config.*", "num_workers").collect()
    specs, states, by_w = {}, {}, {}
    for r in rows:
        layers = [in_width, r["l1"], r["l2"], r["l3"], n_classes]
        wbs = tr.worker_batch_size(r["batch_size"], r["num_workers"])
        specs[r["trial_id"]] = tr.ModelSpec(r["trial_id"], layers, float(r["lr"]), wbs)
        states[r["trial_id"]] = tr.TrainState.fresh(layers, f"{seed}:{r['trial_id']}")
        by_w.setdefault(r["num_workers"], []).append(r["trial_id"])
    rule = AshaRule(max_epochs, grace_period, reduction_factor)
    live = {r["trial_id"] for r in rows}
    reports, decisions = [], []
    seq, start = 0, 0
    if resume:
        whole = [int(m) for m in marks(spark, f"{checkpoint_path}/done")]
        done = _read_or_none(lambda: read_reports(spark, reports_path)) if whole else None
        for r in (done.where(F.col("epoch").isin(whole)).orderBy("report_seq").collect() if done is not None else []):
            reports.append((r.trial_id, r.epoch, r.training_loss, r.report_seq))
            keep = rule.on_report(r.trial_id, r.epoch, r.training_loss)
            decisions.append((r.trial_id, r.epoch, keep))
            if not keep:
                live.discard(r.trial_id)
            seq, start = r.report_seq + 1, max(start, r.epoch)
        for t in live:
            if start:
                states[t] = tr.read_checkpoint(spark, state_path, t, specs[t].layers, start)
    bases = {}
    if mode == "local":
        bases = {w: tr.shard_table(train_df, key, w, seed, features, label) for w in by_w}
    tables = _Tables(train_df, key, seed, features, label, shuffle,
                     {w: min(specs[t].batch_size * w for t in ids) for w, ids in by_w.items()})
    try:
        for epoch in range(start, max_epochs):
            if not live:
                break
            results = (_search_epoch(bases, by_w, specs, states, live, key, seed, features, label, shuffle)
                       if mode == "local" else _sync_search_epoch(tables, by_w, specs, states, live, epoch))
            tr.write_checkpoints(spark, state_path, {t: results[t][0] for t in sorted(results)})
            new = []
            for t in sorted(results):
                st, loss, _ = results[t]
                new.append((t, epoch + 1, float(loss), seq))
                seq += 1
                keep = rule.on_report(t, epoch + 1, loss)
                decisions.append((t, epoch + 1, keep))
                if not keep:
                    live.discard(t)
            write_epoch_reports(spark.createDataFrame(new, REPORTS_SCHEMA), reports_path)
            mark(spark, f"{checkpoint_path}/done/{epoch + 1}")
            reports += new
    finally:
        for b in bases.values():
            b.unpersist()
        tables.close()
    rep = spark.createDataFrame(reports, REPORTS_SCHEMA)
    return SearchResult(trials, rep, decisions, state_path)


def write_epoch_reports(reports: DataFrame, path: str) -> None:
    """Reports of an epoch in its own folder, written over if it was left unfinished."""
    (reports.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("epoch").parquet(path))


REPORTS_SCHEMA = "trial_id int, epoch int, training_loss double, report_seq long"


def _read_or_none(read):
    from pyspark.errors import AnalysisException
    try:
        df = read()
        df.schema  # noqa: B018 - forces the path lookup
        return df
    except AnalysisException:
        return None


def _search_epoch(bases, by_w, specs, states, live, key, seed, features, label, shuffle):
    """One epoch for all live trials.  Trials with the same world size share the
    cached shard table and one job: the data is sorted and scanned once per
    epoch, and every task trains all of them on its shard."""
    from strata.operators import train as tr
    results = {}
    for w, ids in sorted(by_w.items()):
        group = [specs[t] for t in sorted(ids) if t in live]
        if group:
            tr.run_epochs(bases[w], key, group, states, seed, 1, features, label, shuffle,
                          on_epoch=lambda e, res: results.update(res))
    return results


class _Tables:
    """The train split laid out for shared steps, per world size: one layout
    for a fixed order, one an epoch with ``shuffle``."""

    def __init__(self, train_df, key, seed, features, label, shuffle, batch_rows):
        self.args, self.shuffle, self.batch_rows = (train_df, key, seed, features, label), shuffle, batch_rows
        self.held: dict = {}
        self.n = None

    def get(self, world_size: int, epoch: int):
        from strata.operators import train as tr
        df, key, seed, features, label = self.args
        at = epoch if self.shuffle else None
        if self.held.get(world_size, (None, object()))[1] != at:
            self._drop(world_size)
            self.n = df.count() if self.n is None else self.n
            self.held[world_size] = (tr.spread_table(df, key, world_size, seed, at, self.batch_rows[world_size],
                                                     features, label, self.n), at)
        return self.held[world_size][0]

    def _drop(self, world_size: int) -> None:
        if world_size in self.held:
            self.held.pop(world_size)[0].rows.unpersist()

    def close(self) -> None:
        for w in list(self.held):
            self._drop(w)


def _sync_search_epoch(tables, by_w, specs, states, live, epoch):
    """One epoch of exact mini-batch steps for all live trials: those of one world
    size share the table, and each step is one job for all of them."""
    from strata.operators import train as tr
    results = {}
    for w, ids in sorted(by_w.items()):
        group = [specs[t] for t in sorted(ids) if t in live]
        if group:
            results |= tr.spread_epoch(tables.get(w, epoch), group, states, w, tables.args[3], tables.args[4])
    states.update({t: r[0] for t, r in results.items()})
    return results


def evaluate_best(result: SearchResult, test_df: DataFrame, key: str, *, in_width: int,
              n_classes: int, world_size: int = 2, batch_size: int = 10, seed: object = 0,
              features: str = "features", label: str = "label") -> DataFrame:
    """H9: load the best trial's checkpoint (strict) and report its test
    accuracy per worker (correct / (n // W)) and over all rows."""
    from strata.operators import train as tr
    spark = test_df.sparkSession
    best = best_config(best_trial(result.reports), result.trials).select(
        "trial_id", "config.*").first()
    layers = [in_width, best["l1"], best["l2"], best["l3"], n_classes]
    state = tr.read_checkpoint(spark, result.checkpoint_path, best["trial_id"], layers)
    ev, n = tr.eval_table(test_df, key, world_size, batch_size, seed, features, label)
    try:
        r = tr.evaluate(ev, state, n, world_size, features, label)
    finally:
        ev.unpersist()
    rows = [(int(best["trial_id"]), int(s), float(a), float(r["accuracy"]))
            for s, a in sorted(r["shard_accuracy"].items())]
    return spark.createDataFrame(rows, "trial_id int, shard int, accuracy double, "
                                       "global_accuracy double")
