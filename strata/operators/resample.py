"""Class-imbalance resampling (SMOTE, random undersampling).

Targets follow the float ``sampling_strategy`` rules of the usual library:

* over-sampling to ratio r: each non-majority class gets
  ``int(r * n_majority - n_class)`` synthetic rows (negative -> error);
* under-sampling to ratio r: each non-minority class keeps
  ``int(n_minority / r)`` rows (more than it has -> error).

SMOTE (Chawla et al. 2002): a synthetic row is ``x + gap * (nn - x)`` for a
minority row x, one of its k nearest minority neighbours nn (Euclidean,
self excluded, ties by key) and gap ~ U[0,1).  All draws are md5 hashes of
(seed, index), so the result does not depend on partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import uniform
from strata.operators.knn import knn
from strata.operators.rank import cut_keys_of_groups, hash_rank, rank_at_most, with_hash, HASH
from strata.session import materialize, release


# ---------------------------------------------------------------- D1

def class_counts(df: DataFrame, label: str) -> dict:
    """Per-class row counts (one small aggregate; k rows reach the driver)."""
    counts = {r[label]: r["n"] for r in
              df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if None in counts:
        raise ValueError(f"{counts[None]} rows have no label in column {label}")
    return counts


def oversample_targets(counts: dict, ratio: float) -> dict:
    """Synthetic rows per class for SMOTE(sampling_strategy=ratio)."""
    maj_class = max(counts, key=lambda c: (counts[c], str(c)))
    n_maj = counts[maj_class]
    out = {}
    for c, n in counts.items():
        if c == maj_class:
            continue
        need = int(n_maj * ratio - n)
        if need < 0:
            raise ValueError("the ratio asks to remove minority rows while over-sampling")
        out[c] = need
    return out


def undersample_targets(counts: dict, ratio: float) -> dict:
    """Rows kept per class for random under-sampling to ``ratio``."""
    min_class = min(counts, key=lambda c: (counts[c], str(c)))
    n_min = counts[min_class]
    out = {}
    for c, n in counts.items():
        if c == min_class:
            continue
        keep = int(n_min / ratio)
        if keep > n:
            raise ValueError("the ratio asks to add majority rows while under-sampling")
        out[c] = keep
    return out


# ---------------------------------------------------------------- D3

@dataclass
class SmoteResult:
    synthetic: DataFrame
    neighbours: DataFrame


def smote_rows(minority: DataFrame, key: str, features: str, n_new: int, seed: object,
               k: int = 5, neighbours: DataFrame | None = None,
               n_min: int | None = None, key_offset: int = 0) -> SmoteResult:
    """``n_new`` synthetic rows ``(key = key_offset-i-1, features)`` from a minority
    table.  Row i draws ``idx = floor(u1 * n_min * k)`` (base row =
    idx // k in the hash order of the minority, neighbour = idx % k) and a
    gap u2, from ``md5("seed:smote:i")``."""
    spark = minority.sparkSession
    n_min = minority.count() if n_min is None else n_min
    nbrs = neighbours if neighbours is not None else knn(minority, key, features, k, n=n_min)
    ranked = hash_rank(minority.select(key, features), key, seed, "minority",
                       rank_col="__base")
    h = F.md5(F.concat(F.lit(f"{seed}:smote:"), F.col("id").cast("string")))
    draws = spark.range(n_new).select(
        F.col("id").alias("i"),
        F.floor(uniform(h, 0) * F.lit(n_min * k)).cast("long").alias("__idx"),
        uniform(h, 8).alias("gap"))
    draws = draws.select("i", "gap", (F.floor(F.col("__idx") / k) + 1).cast("long").alias("__base"),
                         (F.col("__idx") % k).cast("int").alias("nbr_rank"))
    base = draws.join(ranked, "__base").select("i", "gap", "nbr_rank", F.col(key).alias("__k"),
                                               F.col(features).alias("__x"))
    with_nb = base.join(nbrs.select(F.col(key).alias("__k"), "nbr_rank", "nbr_key"),
                        ["__k", "nbr_rank"])
    nb_x = minority.select(F.col(key).alias("nbr_key"), F.col(features).alias("__nx"))
    syn = with_nb.join(nb_x, "nbr_key").select(
        (F.lit(key_offset) - F.col("i") - 1).cast(minority.schema[key].dataType).alias(key),
        F.zip_with("__x", "__nx", lambda a, b: a + F.col("gap") * (b - a)).alias(features))
    return SmoteResult(syn, nbrs)


def smote(df: DataFrame, key: str, label: str, features: str = "features",
          ratio: float = 0.03, seed: object = 0, k: int = 5,
          counts: dict | None = None) -> DataFrame:
    """D3: originals plus synthetic minority rows up to ``ratio`` of the
    majority count (binary or multi-class, one pass per short class)."""
    return _smote(df, key, label, features, ratio, seed, k, counts)[0]


def _smote(df, key, label, features, ratio, seed, k, counts):
    counts = class_counts(df, label) if counts is None else counts
    targets = oversample_targets(counts, ratio)
    out = df.select(key, features, label)
    after = dict(counts)
    # synthetic keys count down from below the smallest key (0 if none is
    # negative), so they are unique across classes and differ from all originals
    low = df.agg(F.min(key)).first()[0] if any(targets.values()) else 0
    offset = min(0, low or 0)
    for cls, n_new in sorted(targets.items(), key=lambda t: str(t[0])):
        if n_new == 0:
            continue
        # read by the neighbour search, the ranking and the draws: written once
        minority = _checkpoint(df.filter(F.col(label) == F.lit(cls)).select(key, features))
        syn = smote_rows(minority, key, features, n_new, f"{seed}:{cls}" if len(targets) > 1
                         else seed, k, n_min=counts[cls], key_offset=offset).synthetic
        offset -= n_new
        # the synthetic rows are small (n_new rows) and the costly part to
        # recompute: write them to the shared checkpoint folder, cutting lineage
        syn = _checkpoint(syn)
        release(minority)
        out = out.unionByName(syn.withColumn(label, F.lit(cls).cast(df.schema[label].dataType)))
        after[cls] += n_new
    return out, after


def _checkpoint(df: DataFrame) -> DataFrame:
    return materialize(df, "smote")


def resample_plan(df: DataFrame, label: str, over: float = 0.03,
                  under: float = 0.3) -> DataFrame:
    """D1 as a table: per class the count before, after SMOTE(over) and after
    undersampling(under), by the rules the resamplers follow; raises where
    they do.  One aggregate; one row per class reaches the driver."""
    counts = class_counts(df, label)
    after = {c: n + oversample_targets(counts, over).get(c, 0) for c, n in counts.items()}
    final = after | undersample_targets(after, under)
    kind = df.schema[label].dataType.simpleString()
    return df.sparkSession.createDataFrame(
        [(c, n, after[c], final[c]) for c, n in counts.items()],
        f"{label} {kind}, n long, n_smote long, n_final long")


# ---------------------------------------------------------------- D4

def undersample(df: DataFrame, key: str, label: str, ratio: float = 0.3,
                seed: object = 0, counts: dict | None = None) -> DataFrame:
    """Keep exactly ``int(n_min / ratio)`` rows of each larger class, the
    ones first in ``md5("seed:under:key")`` order; the cut rows of all classes are
    found together by bucket counts, the rows are then filtered in place (no shuffle)."""
    counts = class_counts(df, label) if counts is None else counts
    keep = undersample_targets(counts, ratio)
    group = F.lit(None).cast("int")
    for i, cls in enumerate(keep):
        group = F.when(F.col(label) == F.lit(cls), F.lit(i)).otherwise(group)
    cuts = cut_keys_of_groups(df, key, group, {i: [k] for i, (cls, k) in enumerate(keep.items()) if 0 < k < counts[cls]},
                              seed, "under")
    conds = []
    for i, (cls, n_keep) in enumerate(keep.items()):
        conds.append((F.col(label) == F.lit(cls)) &
                     rank_at_most([key], cuts.get((i, n_keep)), counts[cls], n_keep))
    kept_others = ~F.col(label).isin([F.lit(c) for c in keep])
    cond = kept_others
    for c in conds:
        cond = cond | c
    return with_hash(df, key, seed, "under").filter(cond).drop(HASH)


# ---------------------------------------------------------------- D5

def smote_then_undersample(df: DataFrame, key: str, label: str, features: str = "features",
                           over: float = 0.03, under: float = 0.3, seed: object = 0,
                           k: int = 5) -> DataFrame:
    """The two resamplers chained, as one lazy plan."""
    over_df, counts = _smote(df, key, label, features, over, seed, k, None)
    return undersample(over_df, key, label, under, seed, counts=counts)
