"""Exact pseudo-random global order without a single-partition sort.

Rows are ordered by ``(md5("<seed>:...:<key>"), key)``.  md5 digests are
uniform, so a prefix of the hex digest is a balanced bucket id whatever the
key distribution (a unique key is required; the digest of equal keys is
equal).  A null key fails the query; so does a repeated one wherever it would
make an order or a cut ambiguous.  Two plans are offered:

``hash_rank``   every row gets its 1-based rank.  One shuffle by bucket
                (window ``row_number`` inside a bucket) plus a broadcast of
                the per-bucket offsets; the offset table has at most
                ``16 ** BUCKET_DIGITS`` rows, a fixed bound.  Two neighbours
                with one digest mean a repeated key and fail the query; a
                bucket far above its binomial size is refused before it is
                ranked in one task.

``cut_keys``    only the rows at a few target ranks are found (the last row
                of each split).  Bucket counts are refined digit group by
                digit group inside the boundary bucket until it is small,
                then that bucket alone is ranked.  No data shuffle: the
                split itself is then a pure comparison against the cut rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.hashing import as_list, row_hash

BUCKET_DIGITS = 4          # 65,536 buckets per refinement level
FINAL_BUCKET_ROWS = 200_000  # refine a boundary bucket until it is no larger than this
HASH = "__h"


NULL_MESSAGE = "null ordering key: rows cannot be ordered, split or sampled by it"
DUPLICATE_MESSAGE = "the ordering key is not unique"


def with_hash(df: DataFrame, key: str | Sequence[str], *parts: object) -> DataFrame:
    """Add the digest; a row with a null in its key fails the query."""
    null = F.lit(False)
    for k in as_list(key):
        null = null | F.col(k).isNull()
    return df.withColumn(HASH, F.when(null, F.raise_error(F.lit(NULL_MESSAGE)).cast("string"))
                         .otherwise(row_hash(key, *parts)))


class DuplicateKeyError(ValueError):
    """The ordering key is not unique (a hot group of equal keys)."""


def _bucket_limit(total: Column) -> Column:
    """md5 buckets of distinct keys are binomial with mean total/16^d; a
    bucket above this limit holds a hot group of equal keys."""
    mean = total / F.lit(float(16 ** BUCKET_DIGITS))
    return F.lit(8.0) * mean + F.lit(64.0) * F.sqrt(mean) + F.lit(10_000.0)


def hash_rank(df: DataFrame, key: str | Sequence[str], seed: object, *salt: object,
              rank_col: str = "rank") -> DataFrame:
    """Add ``rank_col`` (1..n, long) ordering rows by ``(md5(seed:salt:key), key)``.

    One shuffle by bucket (``row_number`` inside a bucket) and a broadcast
    join of the per-bucket offsets, computed in the same plan from the bucket
    counts (at most 65,536 rows, a fixed bound).  Equal keys have equal
    digests, so they are neighbours in a bucket: the same window fails the
    query on a repeated key.  The offsets carry a guard against a hot key:
    a bucket far above its binomial size fails before it is ranked."""
    keys = as_list(key)
    hd = with_hash(df, keys, seed, *salt).withColumn(
        "__b", F.substring(F.col(HASH), 1, BUCKET_DIGITS))
    counts = hd.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("__n").over(Window.partitionBy())
    guard = F.assert_true(F.col("__n") <= _bucket_limit(total), F.lit(DUPLICATE_MESSAGE))
    offsets = counts.select(
        "__b", (F.coalesce(before, F.lit(0)) + F.coalesce(guard.cast("long"), F.lit(0)))
        .alias("__off"))
    w = Window.partitionBy("__b").orderBy(HASH, *keys)
    repeated = F.coalesce(F.lag(HASH).over(w) == F.col(HASH), F.lit(False))
    ranked = hd.withColumn("__rn", F.row_number().over(w)).withColumn(
        "__rn", F.when(repeated, F.raise_error(F.lit(DUPLICATE_MESSAGE)).cast("int"))
        .otherwise(F.col("__rn")))
    # left join: every bucket has an offset, and an inner join would make
    # Catalyst push a second md5 evaluation down as an inferred not-null filter
    out = ranked.join(F.broadcast(offsets), "__b", "left").withColumn(
        rank_col, (F.col("__off") + F.col("__rn")).cast("long"))
    return out.drop("__b", "__off", "__rn", HASH)


def _tuple_le(keys: list[str], cut: tuple) -> Column:
    """(hash, key...) <= cut, lexicographically."""
    cols = [F.col(HASH)] + [F.col(k) for k in keys]
    expr = None
    for i in reversed(range(len(cols))):
        c, v = cols[i], F.lit(cut[i])
        term = (c <= v) if expr is None else ((c < v) | ((c == v) & expr))
        expr = term
    return expr


def cut_keys(df: DataFrame, key: str | Sequence[str], targets: Sequence[int],
             seed: object, *salt: object) -> dict[int, tuple]:
    """For each 1-based target rank t, the ``(hash, key...)`` of the row at rank t
    (``cut_keys_of_groups`` with all rows in one group)."""
    found = cut_keys_of_groups(df, key, F.lit(0), {0: targets}, seed, *salt)
    return {t: cut for (_, t), cut in found.items()}


def cut_keys_of_groups(df: DataFrame, key: str | Sequence[str], group: Column,
                       targets: dict[int, Sequence[int]], seed: object, *salt: object) -> dict[tuple[int, int], tuple]:
    """For each group (an int column; rows of others are left out) and 1-based target rank
    within it, the ``(hash, key...)`` of that row: ``{(group, rank): cut}``.

    Each level is one scan of the key column and an aggregation to at most
    ``16**BUCKET_DIGITS`` counts per open bucket, for all groups at once, so the number
    of jobs does not depend on theirs; only the rows answering the
    query reach the driver.  A row at a target must be the only one with its
    key, else the rows up to it are not ``target`` many: that fails.
    """
    keys = as_list(key)
    spark = df.sparkSession
    hk = with_hash(df.select(*keys, group.alias("__g")), keys, seed, *salt)
    # pending: (group, target) -> (prefix, residual rank inside the prefix)
    pending = {(g, t): ("", t) for g, ts in targets.items() for t in sorted({int(t) for t in ts}) if t > 0}
    found: dict[tuple[int, int], tuple] = {}
    plen = 0
    while pending:
        nlen = min(plen + BUCKET_DIGITS, 32)
        open_ = {(g, p) for (g, _), (p, _) in pending.items()}
        some = hk.filter(F.col("__g").isin(sorted({g for g, _ in open_})))
        sub = some if plen == 0 else some.filter(F.substring(HASH, 1, plen).isin(sorted({p for _, p in open_})))
        counts = sub.groupBy("__g", F.substring(HASH, 1, plen).alias("pp"),
                             F.substring(HASH, 1, nlen).alias("b")).agg(
            F.count(F.lit(1)).alias("n"))
        cum = counts.withColumn("cum", F.sum("n").over(
            Window.partitionBy("__g", "pp").orderBy("b")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        pend_df = spark.createDataFrame(
            [(g, t, p, r) for (g, t), (p, r) in pending.items()], "__g int, t long, pp string, r long")
        hits = (cum.join(F.broadcast(pend_df), ["__g", "pp"])
                .filter((F.col("cum") - F.col("n") < F.col("r")) & (F.col("r") <= F.col("cum")))
                .select("__g", "t", "b", (F.col("r") - (F.col("cum") - F.col("n"))).alias("r2"), "n")
                .collect())
        if len(hits) != len(pending):
            raise ValueError("target rank beyond the row count")
        nxt = {}
        final = []
        for h in hits:
            if nlen >= 32 and h["n"] > 1:
                raise DuplicateKeyError(
                    f"{h['n']} rows share one key digest: the key is not unique")
            if h["n"] <= FINAL_BUCKET_ROWS or nlen >= 32:
                final.append((h["__g"], h["t"], h["b"], h["r2"]))
            else:
                nxt[h["__g"], h["t"]] = (h["b"], h["r2"])
        if final:
            fb = spark.createDataFrame(final, "__g int, t long, b string, r2 long")
            bs = sorted({b for _, _, b, _ in final})
            fin = (some.filter(F.substring(HASH, 1, nlen).isin(bs))
                   .withColumn("b", F.substring(HASH, 1, nlen))
                   .withColumn("r2", F.row_number().over(
                       Window.partitionBy("__g", "b").orderBy(HASH, *keys)).cast("long"))
                   .withColumn("same", F.count(F.lit(1)).over(Window.partitionBy("__g", "b", HASH)))
                   .join(F.broadcast(fb), ["__g", "b", "r2"])
                   .select("__g", "t", "same", HASH, *keys).collect())
            for row in fin:
                if row["same"] > 1:
                    raise DuplicateKeyError(f"{row['same']} rows share the key at a cut: {DUPLICATE_MESSAGE}")
                found[row["__g"], row["t"]] = tuple(row[c] for c in [HASH, *keys])
        pending = nxt
        plen = nlen
    return found


def rank_at_most(keys: str | Sequence[str], cut: tuple | None, n_total: int,
                 target: int) -> Column:
    """Predicate: the row's rank is <= target, given the cut row at that rank."""
    if target <= 0:
        return F.lit(False)
    if target >= n_total:
        return F.lit(True)
    return _tuple_le(as_list(keys), cut)
