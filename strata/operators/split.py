"""Exact splits, per-epoch order, batches and shards.

Sizes follow the usual library rules: a train fraction p keeps floor(p*n)
rows (E1); a list of fractions gets floor(f_i*n) each and the remainder is
handed out one row at a time from the first part (E2).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import as_list
from strata.operators.rank import HASH, cut_keys, hash_rank, rank_at_most, with_hash


def split_sizes(n: int, fractions: Sequence[float]) -> list[int]:
    """Row count per part for fractions summing to 1 (or integer lengths)."""
    if all(isinstance(f, int) for f in fractions):
        if sum(fractions) != n:
            raise ValueError("lengths must sum to the row count")
        return list(fractions)
    if not math.isclose(sum(fractions), 1.0) or any(f < 0 for f in fractions):
        raise ValueError("fractions must be >= 0 and sum to 1")
    sizes = [int(math.floor(n * f)) for f in fractions]
    for i in range(n - sum(sizes)):
        sizes[i % len(sizes)] += 1
    return sizes


def train_size(n: int, p: float) -> int:
    """floor(p*n) train rows; the rest is test."""
    if not 0.0 < p < 1.0:
        raise ValueError("train fraction must be in (0, 1)")
    return int(math.floor(p * n))


def assign_split(df: DataFrame, key: str | Sequence[str], sizes: Sequence[int], seed: object,
                 *salt: object, split_col: str = "split", n: int | None = None) -> DataFrame:
    """Add ``split_col`` (0..k-1): the first sizes[0] rows of the hash order go
    to part 0, the next sizes[1] to part 1, and so on.  Exact counts; the rows
    are not moved (no shuffle), each is compared with k-1 cut rows."""
    keys = as_list(key)
    n = df.count() if n is None else n
    if sum(sizes) != n:
        raise ValueError(f"sizes {list(sizes)} do not add up to {n} rows")
    bounds = []
    acc = 0
    for s in sizes[:-1]:
        acc += s
        bounds.append(acc)
    cuts = cut_keys(df, keys, [b for b in bounds if 0 < b < n], seed, *salt)
    part = F.lit(len(sizes) - 1)
    for i in reversed(range(len(bounds))):
        part = F.when(rank_at_most(keys, cuts.get(bounds[i]), n, bounds[i]), F.lit(i)) \
            .otherwise(part)
    return with_hash(df, keys, seed, *salt).withColumn(split_col, part.cast("int")).drop(HASH)


def random_split(df: DataFrame, key: str | Sequence[str], fractions: Sequence[float],
                 seed: object = 0) -> list[DataFrame]:
    """Exact-count split by fractions (E2); one DataFrame per part."""
    n = df.count()
    tagged = assign_split(df, key, split_sizes(n, fractions), seed, n=n, split_col="__split")
    return [tagged.filter(F.col("__split") == i).drop("__split") for i in range(len(fractions))]


def train_test_split(df: DataFrame, key: str | Sequence[str], train_fraction: float,
                     seed: object = 0) -> tuple[DataFrame, DataFrame]:
    """Exact shuffled split with floor(p*n) train rows."""
    n = df.count()
    ntr = train_size(n, train_fraction)
    tagged = assign_split(df, key, [ntr, n - ntr], seed, n=n, split_col="__split")
    return (tagged.filter(F.col("__split") == 0).drop("__split"),
            tagged.filter(F.col("__split") == 1).drop("__split"))


def epoch_order(df: DataFrame, key: str | Sequence[str], seed: object, epoch: int,
                pos_col: str = "pos") -> DataFrame:
    """Reshuffle per epoch (E3): 0-based position in the order of
    ``md5(seed:epoch:key)``."""
    return hash_rank(df, key, seed, epoch, rank_col="__r").withColumn(
        pos_col, F.col("__r") - 1).drop("__r")


def batches(df: DataFrame, key: str | Sequence[str], batch_size: int, seed: object,
            *salt: object, drop_last: bool = False, batch_col: str = "batch_id",
            n: int | None = None) -> DataFrame:
    """Consecutive batches of ``batch_size`` in hash order (E4 drop_last=True,
    E5 drop_last=False)."""
    if batch_size <= 0:
        raise ValueError("batch size must be positive")
    out = hash_rank(df, key, seed, *salt, rank_col="__r")
    out = out.withColumn(batch_col, F.floor((F.col("__r") - 1) / F.lit(batch_size)).cast("long"))
    if drop_last:
        n = df.count() if n is None else n
        out = out.filter(F.col(batch_col) < F.lit(n // batch_size))
    return out.drop("__r")


def worker_batch_size(batch_size: int, world_size: int) -> int:
    """Per-worker batch = global batch // world size."""
    b = batch_size // world_size
    if b <= 0:
        raise ValueError(f"batch size {batch_size} is smaller than world size {world_size}")
    return b


def shards(df: DataFrame, key: str | Sequence[str], world_size: int, seed: object,
           *salt: object, pad: bool = True, n: int | None = None, with_count: bool = False):
    """Deal rows to ``world_size`` shards round-robin in hash order.

    Adds ``pos`` (0-based position in the padded order), ``shard`` and
    ``local_pos`` (position inside the shard).  With ``pad`` the first
    ``(-n) mod W`` rows are repeated at the end so every shard has the same
    length, as a distributed sampler does."""
    if world_size <= 0:
        raise ValueError("world size must be positive")
    ranked = hash_rank(df, key, seed, *salt, rank_col="__r")
    if n is None and (pad or with_count):
        n = df.count()
    extra = (-n) % world_size if pad else 0
    if extra > n:
        raise ValueError("cannot pad: fewer rows than shards")
    if extra:
        # the first `extra` rows also take the positions n .. n+extra-1:
        # one pass (explode), no second copy of the ranking plan
        pos = F.explode(F.when(F.col("__r") <= extra,
                               F.array(F.col("__r") - 1, F.col("__r") - 1 + n))
                        .otherwise(F.array(F.col("__r") - 1)))
        ranked = ranked.select("*", pos.alias("pos"))
    else:
        ranked = ranked.withColumn("pos", F.col("__r") - 1)
    out = (ranked.withColumn("shard", (F.col("pos") % world_size).cast("int"))
           .withColumn("local_pos", F.floor(F.col("pos") / world_size).cast("long"))
           .drop("__r"))
    return (out, n) if with_count else out


def shard_batches(sharded: DataFrame, batch_size: int, drop_last: bool = False,
                  batch_col: str = "batch_id") -> DataFrame:
    """Batches inside each shard from ``local_pos`` (E5 per worker)."""
    out = sharded.withColumn(batch_col, F.floor(F.col("local_pos") / batch_size).cast("long"))
    if drop_last:
        sizes = sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("__m"))
        out = out.join(F.broadcast(sizes), "shard").filter(
            F.col(batch_col) < F.floor(F.col("__m") / batch_size)).drop("__m")
    return out


def shard_stats(sharded: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Rows and batches per shard (E8); batch ids are contiguous from 0."""
    return sharded.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"),
        (F.max(batch_col) + 1).cast("long").alias("batches"))
