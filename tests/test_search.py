"""Search: draws, ASHA golden, table rule = online rule, best trial."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import mlp
from strata.operators import search as srch
from strata.operators import train as tr
from strata.session import scratch_path


def test_milestones():
    assert srch.rung_milestones(50) == [1, 2, 4, 8, 16, 32]
    assert srch.rung_milestones(80) == [1, 2, 4, 8, 16, 32, 64]


def test_asha_golden_one_rung(spark):
    rep = spark.createDataFrame([(1, 1, 0.9, 1), (2, 1, 0.5, 2), (3, 1, 0.8, 3), (4, 1, 0.4, 4)],
                                "trial_id int, epoch int, training_loss double, report_seq long")
    out = srch.asha_prune(rep, max_t=2).orderBy("report_seq").collect()
    assert [r.stop for r in out] == [0, 0, 1, 0]
    assert [r.cutoff for r in out] == [None, 0.9, pytest.approx(0.7), pytest.approx(0.8)]
    rule = srch.AshaRule(2)
    assert [rule.on_report(t, 1, l) for t, l in [(1, .9), (2, .5), (3, .8), (4, .4)]] == \
        [True, True, False, True]


def test_table_rule_matches_online_rule(spark):
    import random
    rnd = random.Random(3)
    rule = srch.AshaRule(16)
    rows, live, seq = [], set(range(12)), 0
    for ep in range(1, 16):
        for t in sorted(live):
            loss = rnd.random()
            rows.append((t, ep, loss, seq))
            seq += 1
            if not rule.on_report(t, ep, loss):
                live.discard(t)
    rep = spark.createDataFrame(rows, "trial_id int, epoch int, training_loss double, "
                                      "report_seq long")
    dec = srch.asha_prune(rep, max_t=16).filter("stop = 1").select("trial_id").collect()
    stopped_table = {r.trial_id for r in dec}
    assert stopped_table == set(range(12)) - live


def test_draw_ranges(spark):
    t = srch.make_trials(spark, 200, srch.reference_space(), 7).select(
        "trial_id", "config.*").collect()
    assert {r.batch_size for r in t} <= {20, 40, 60, 80}
    assert {r.l1 for r in t} <= {64, 128, 256, 512}
    assert {r.l2 for r in t} <= {32, 64, 128, 256}
    assert {r.l3 for r in t} <= {8, 16, 32, 64}
    assert all(1e-4 <= r.lr < 1e-1 for r in t)
    assert {r.num_workers for r in t} == {1, 2}
    again = srch.make_trials(spark, 200, srch.reference_space(), 7).select(
        "trial_id", "config.*").collect()
    assert again == t


def test_user_defined_draw(spark):
    space = {"depth": lambda u: (F.lit(2) + F.floor(u * 3)).cast("int")}
    vals = {r.depth for r in srch.make_trials(spark, 50, space, 1).select("config.depth")
            .collect()}
    assert vals <= {2, 3, 4}


def test_best_trial_uses_last_report(spark):
    rep = spark.createDataFrame([(1, 1, 0.1, 0), (1, 2, 0.9, 2), (2, 1, 0.5, 1)],
                                "trial_id int, epoch int, training_loss double, report_seq long")
    b = srch.best_trial(rep).first()
    assert (b.trial_id, b.training_loss) == (2, 0.5)


def test_search_resume_equals_uninterrupted(spark):
    import uuid
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 3))
    rows = [(int(i), [float(v) for v in x[i]], int(x[i, 0] > 0)) for i in range(120)]
    df = spark.createDataFrame(rows, "key long, features array<double>, label int")
    space = {"batch_size": srch.choice([20, 40]), "l1": srch.pow2_randint(2, 4),
             "l2": srch.pow2_randint(2, 4), "l3": srch.pow2_randint(2, 3),
             "lr": srch.loguniform(1e-3, 1e-2), "num_workers": srch.choice([1, 2])}
    trials = srch.make_trials(spark, 4, space, 5,
                              config_cols=["batch_size", "l1", "l2", "l3", "lr"])
    kw = dict(in_width=3, n_classes=2, seed=5)
    full = srch.run_search(df, "key", trials, max_epochs=4,
                           checkpoint_path=scratch_path(spark, uuid.uuid4().hex), **kw)
    path = scratch_path(spark, uuid.uuid4().hex)
    srch.run_search(df, "key", trials, max_epochs=2, checkpoint_path=path, **kw)
    resumed = srch.run_search(df, "key", trials, max_epochs=4, checkpoint_path=path,
                              resume=True, **kw)
    a = sorted(map(tuple, full.reports.collect()))
    b = sorted(map(tuple, resumed.reports.collect()))
    assert [r[:2] + (r[3],) for r in a] == [r[:2] + (r[3],) for r in b]
    np.testing.assert_allclose([r[2] for r in a], [r[2] for r in b], atol=1e-12)
    best = srch.best_trial(full.reports).first().trial_id
    layers = [3] + [r for r in trials.filter(f"trial_id = {best}")
                    .select("config.l1", "config.l2", "config.l3").first()] + [2]
    s1 = tr.read_checkpoint(spark, full.checkpoint_path, best, layers)
    s2 = tr.read_checkpoint(spark, resumed.checkpoint_path, best, layers)
    np.testing.assert_allclose(mlp.flatten(s1.params), mlp.flatten(s2.params), atol=1e-12)


def test_max_mode_mirrors_min_mode(spark):
    losses = [0.9, 0.5, 0.8, 0.4, 0.7]
    lo = srch.AshaRule(2)
    hi = srch.AshaRule(2, mode="max")
    assert [lo.on_report(t, 1, v) for t, v in enumerate(losses)] == \
        [hi.on_report(t, 1, -v) for t, v in enumerate(losses)]
    rep = spark.createDataFrame([(t, 1, -v, t) for t, v in enumerate(losses)],
                                "trial_id int, epoch int, training_loss double, report_seq long")
    table = [r.stop for r in srch.asha_prune(rep, 2, mode="max").orderBy("report_seq").collect()]
    online = srch.AshaRule(2)
    assert table == [0 if online.on_report(t, 1, v) else 1 for t, v in enumerate(losses)]


@pytest.mark.parametrize("where", ["before the reports", "before the mark"])
def test_a_search_killed_between_its_writes_resumes_as_if_uninterrupted(spark, monkeypatch, where):
    """State and reports of an epoch become visible together."""
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, [float(v) for v in rng.normal(size=3)], int(i % 2)) for i in range(80)],
                               "key long, features array<double>, label int")
    trials = spark.createDataFrame([(t, (20, 4, 3, 3, lr), 1) for t, lr in enumerate((0.05, 0.01, 0.02))],
                                   "trial_id int, config struct<batch_size: int, l1: int, l2: int, l3: int, lr: double>, num_workers int")
    how = dict(in_width=3, n_classes=2, max_epochs=4, seed=3)
    full = srch.run_search(df, "key", trials, checkpoint_path=scratch_path(spark, f"full-{where[-4:]}"), **how)
    path, name = scratch_path(spark, f"killed-{where[-4:]}"), "write_epoch_reports" if "reports" in where else "mark"
    real, calls = getattr(srch, name), []

    def dies(*a):
        calls.append(a)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return real(*a)

    monkeypatch.setattr(srch, name, dies)
    with pytest.raises(KeyboardInterrupt):
        srch.run_search(df, "key", trials, checkpoint_path=path, **how)
    monkeypatch.setattr(srch, name, real)
    again = srch.run_search(df, "key", trials, checkpoint_path=path, resume=True, **how)
    assert sorted(map(tuple, again.reports.collect())) == sorted(map(tuple, full.reports.collect()))
    for t in {r["trial_id"] for r in full.reports.collect()}:
        a, b = (tr.read_checkpoint(spark, r.checkpoint_path, t, [3, 4, 3, 3, 2]) for r in (full, again))
        assert a.epoch == b.epoch and np.array_equal(mlp.flatten(a.params), mlp.flatten(b.params))
