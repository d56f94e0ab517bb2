"""End-to-end jobs: the three entry points of the reference, Spark-first.

prepare_mixed2   read -> drop/select -> split -> scale (fit on train) ->
                 label-encode + drop-first dummies -> feature vector
sharded_training prepared table, exact [0.05, 0.95] split, 3-worker training
search_job       prepared table, trial table, ASHA search, best trial on test
imbalanced_job   rare-positive table, split, scale, SMOTE + undersample on
                 the train split only, training, evaluation

Each step is a lazy plan; the only actions are the small fits (counts,
min/max, level lists), the exact split cut rows and one job per epoch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import features as feat
from strata.operators import project as proj
from strata.operators import resample as rs
from strata.operators import search as srch
from strata.operators import split as spl
from strata.operators import train as tr
from strata.plans import fixtures as fx
from strata.session import materialize


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    width: int
    n_classes: int


def _vectorise(df: DataFrame, key: str, label: str) -> DataFrame:
    """Feature vector of every column but key and label (by name: Q1)."""
    cols = proj.feature_columns(df, label, key)
    return df.select(key, F.array(*[F.col(c).cast("double") for c in cols]).alias("features"),
                     F.col(label).cast("int").alias("label"))


def prepare_mixed2(spark: SparkSession, sf_dir: str, fractions=(0.7, 0.3), seed: object = 42,
                   fit_on: str = "train") -> Prepared:
    """Mixed categorical/numeric binary table: split first, then fit the
    scaler on the train part (``fit_on='all'`` reproduces fitting on all
    rows), encode categories, assemble ``features`` (label kept out by name)."""
    # the join feeds five passes (count, cut, two fits, apply): materialise
    # its pruned output once instead of shuffling the join five times
    df = materialize(fx.mixed2(spark, sf_dir), "mixed2")
    n = df.count()
    tagged = spl.assign_split(df, "o_orderkey", spl.split_sizes(n, list(fractions)), seed, n=n)
    train_raw = tagged.filter(F.col("split") == 0).drop("split")
    scaler = feat.minmax_fit(train_raw if fit_on == "train" else df, fx.MIXED2_NUMERIC)
    enc = feat.label_encoder_fit(df, fx.MIXED2_CATEGORICAL)

    def prep(part: DataFrame) -> DataFrame:
        out = enc.dummies(scaler.apply(part, fx.MIXED2_NUMERIC), fx.MIXED2_CATEGORICAL)
        return _vectorise(out, "o_orderkey", "target")

    train = prep(train_raw)
    test = prep(tagged.filter(F.col("split") == 1).drop("split"))
    width = len(fx.MIXED2_NUMERIC) + sum(len(v) - 1 for v in enc.levels.values())
    return Prepared(train, test, width, 2)


def prepare_rare2(spark: SparkSession, sf_dir: str, seed: object = 42, over: float = 0.03,
                  under: float = 0.3, resample_train: bool = True,
                  reference_order: bool = False, skip_first_row: bool = False) -> Prepared:
    """Rare-positive table.  Default: split 0.7/0.3 exactly, fit the scaler
    on the train part, resample the train part only (no synthetic rows in the
    test split).  ``reference_order`` resamples all rows first, optionally
    skips the first row (by key), fits the scaler on everything and then
    splits [0.7, 0.3] (the order that leaks, kept for comparison)."""
    # parsed once: the splits, fits, counts and neighbour searches below all read it
    df = materialize(fx.rare2(spark, sf_dir).withColumn("label", F.col("Class").cast("int"))
                     .drop("Class"), "rare2")
    if reference_order:
        raw = proj.assemble_features(df, fx.RARE2_FEATURES, keep=["event_id", "label"])
        res = rs.smote_then_undersample(raw, "event_id", "label", "features", over, under, seed)
        if skip_first_row:
            res = proj.skip_first(res, "event_id", 1)
        res = materialize(res, "rare2-resampled")
        cols = [F.col("features")[i].alias(c) for i, c in enumerate(fx.RARE2_FEATURES)]
        wide = proj.cast_features(res.select("event_id", "label", *cols), fx.RARE2_FEATURES)
        scaled = feat.minmax_scale(wide, fx.RARE2_FEATURES)
        vec = proj.assemble_features(scaled, fx.RARE2_FEATURES, keep=["event_id", "label"])
        train, test = spl.random_split(vec, "event_id", [0.7, 0.3], seed)
        return Prepared(train, test, len(fx.RARE2_FEATURES), 2)
    train_raw, test_raw = spl.train_test_split(df, "event_id", 0.7, seed)
    scaler = feat.minmax_fit(train_raw, fx.RARE2_FEATURES)

    def prep(part):
        return proj.assemble_features(scaler.apply(part, fx.RARE2_FEATURES), fx.RARE2_FEATURES,
                                      keep=["event_id", "label"])

    train = prep(train_raw)
    if resample_train:
        train = rs.smote_then_undersample(train, "event_id", "label", "features", over, under,
                                          seed)
    return Prepared(train, prep(test_raw), len(fx.RARE2_FEATURES), 2)


def score_table(prep: Prepared, layers, seed: object = 42) -> DataFrame:
    """Score both splits with a seeded (untrained) model: loss and accuracy per split."""
    from strata.operators import mlp
    from strata.operators.model import score, with_loss
    params = mlp.init_params(layers, seed)
    parts = []
    for i, part in enumerate([prep.train, prep.test]):
        sc = with_loss(score(part, params, keep=["label"]))
        parts.append(sc.withColumn("split", F.lit(i)))
    allsc = parts[0].unionByName(parts[1])
    return allsc.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("loss").alias("loss"),
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))


# The published job settings (epochs, workers, batch sizes,
# learning rates, widths, trials) are the defaults of the jobs below.

def sharded_training(spark: SparkSession, sf_dir: str, epochs: int = 20, world_size: int = 3,
                     batch_size: int = 30, lr: float = 1e-3, seed: object = 42,
                     shuffle: bool = True, mode: str = "local"):
    """Binary MLP (width-128-32-8-2) on 5% of the rows, 3 workers, tested on 95%.

    ``shuffle=False`` keeps one fixed order; ``mode="sync"`` averages gradients at every step."""
    prep = prepare_mixed2(spark, sf_dir, fractions=(0.05, 0.95), seed=seed)
    layers = [prep.width, 128, 32, 8, 2]
    return tr.train_mlp(prep.train, "o_orderkey", layers, lr=lr, batch_size=batch_size,
                        epochs=epochs, world_size=world_size, seed=seed, eval_df=prep.test,
                        shuffle=shuffle, mode=mode)


def search_job(spark: SparkSession, sf_dir: str, num_trials: int = 10, max_epochs: int = 50,
               seed: object = 42, checkpoint_path: str | None = None, shuffle: bool = True):
    """10-trial search with successive halving, best trial tested with 2 workers."""
    from strata.session import ensure_checkpoint_dir, scratch_path
    import uuid
    ensure_checkpoint_dir(spark)
    prep = prepare_mixed2(spark, sf_dir, fractions=(0.05, 0.95), seed=seed)
    trials = srch.make_trials(spark, num_trials, srch.reference_space(), seed,
                              config_cols=["batch_size", "l1", "l2", "l3", "lr"])
    res = srch.run_search(prep.train, "o_orderkey", trials, in_width=prep.width, n_classes=2,
                          max_epochs=max_epochs, seed=seed, shuffle=shuffle,
                          checkpoint_path=checkpoint_path or scratch_path(
                              spark, f"search-{uuid.uuid4().hex}"))
    tested = srch.evaluate_best(res, prep.test, "o_orderkey", in_width=prep.width, n_classes=2,
                            world_size=2, batch_size=10, seed=seed)
    return res, tested


def imbalanced_job(spark: SparkSession, sf_dir: str, epochs: int = 50, batch_size: int = 10,
                   lr: float = 1e-4, seed: object = 42):
    """Resample (train split only), train width-128-32-8-2 on one worker."""
    prep = prepare_rare2(spark, sf_dir, seed=seed)
    layers = [prep.width, 128, 32, 8, 2]
    return tr.train_mlp(prep.train, "event_id", layers, lr=lr, batch_size=batch_size,
                        epochs=epochs, world_size=1, seed=seed, eval_df=prep.test)


def multiclass_job(spark: SparkSession, sf_dir: str, epochs: int = 200, batch_size: int = 5,
                   lr: float = 1e-3, hidden: int = 8, seed: object = 42, mode: str = "local"):
    """Multi-class MLP on one worker: exact 70/30 split, batches in a fixed
    order with the short tail dropped, whole-test-set loss and accuracy per
    epoch (``metrics.row_loss`` / ``metrics.accuracy``).  Uses the keyed
    embeddings table (64 features, 10 classes).  ``mode="sync"`` takes the same steps
    over rows in many tasks (``spread_epoch``); ``local`` streams the rows through one."""
    df = fx.emb10(spark, sf_dir)
    train, test = spl.train_test_split(df, "vec_id", 0.7, seed)
    layers = [64, hidden, 10]
    return tr.train_mlp(train, "vec_id", layers, lr=lr, batch_size=batch_size, epochs=epochs,
                        world_size=1, seed=seed, shuffle=False, drop_last=True, eval_df=test, mode=mode)


def imbalanced_search_job(spark: SparkSession, sf_dir: str, num_trials: int = 15,
                          max_epochs: int = 80, seed: object = 42,
                          checkpoint_path: str | None = None, mode: str = "local",
                          batch_sizes: tuple[int, ...] | None = None):
    """Resampled rare-positive table, 15-trial search (one worker per trial)
    with successive halving, best trial tested with 2 workers.  ``mode="sync"``: the
    same one-worker steps over rows in many tasks (``batch_sizes``: other
    batches to draw from than the published ones)."""
    from strata.session import ensure_checkpoint_dir, scratch_path
    import uuid
    ensure_checkpoint_dir(spark)
    prep = prepare_rare2(spark, sf_dir, seed=seed)
    space = srch.reference_space(*([batch_sizes] if batch_sizes else []), workers=(1,))
    trials = srch.make_trials(spark, num_trials, space, seed,
                              config_cols=["batch_size", "l1", "l2", "l3", "lr"])
    res = srch.run_search(prep.train, "event_id", trials, in_width=prep.width, n_classes=2,
                          max_epochs=max_epochs, seed=seed, mode=mode,
                          checkpoint_path=checkpoint_path or scratch_path(
                              spark, f"search-{uuid.uuid4().hex}"))
    tested = srch.evaluate_best(res, prep.test, "event_id", in_width=prep.width, n_classes=2,
                                world_size=2, batch_size=10, seed=seed)
    return res, tested
