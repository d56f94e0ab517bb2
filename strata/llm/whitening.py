"""Embedding whitening by weighted multiplicity covariance (operator 13).

1. A row's vector becomes whole numbers, ``x = floor(scale * c) + offset``; rows
   with equal x share a digest of it, which is all that is shuffled for them.
2. Rows are counted by digest with partial sums, so a vector that a third of all
   rows hold is one row from here on: the fit list, dealt into blocks by hash and written once.
3. Two passes over the blocks: exact sums of x by weight, then the weighted GEMM of
   the centred block.  Each gives one d x d (or d) row a block; blocks are added in
   their order, so a rerun gives the same bits.  A weight is one or the count.
4. The eigenvectors of that d x d matrix are found on the driver (d is the length
   of a vector, not a number of rows) and each distinct vector is whitened once.
5. The whitened covariance is measured in the same way, and the results are joined
   back to the rows by digest.

x minus a whole mean is exact in a double, so centring loses nothing to the size of ``offset``.

Defined results: a row goes whose vector is null, empty, or holds a null, non-finite
or huge entry (beyond 2**52 after scaling), and one whose length is not the most common length
(ties: the smaller).  Null ids and repeated rows are kept as rows of their own.  Components
whose eigenvalue is not above ``RANK`` times the largest are left out, so a table of one
distinct vector, or an empty one, gives no rows.  A component's largest entry is positive
(ties: the first).  A ``deviation`` beyond a long is null.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import materialize

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Eigenvalues up to this share of the largest count as zero.
RANK = 1e-12
#: Distinct vectors of a block (about), and the least number of blocks.
BLOCK = 8_192
MIN_BLOCKS = 512


def whole_numbers(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, x, key`` of the rows whose vectors are whole and finite."""
    y = F.transform(F.col(vector_col), lambda c: F.floor(c.cast("double") * SCALE))
    fits = F.coalesce(F.forall(F.col(vector_col), lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(c.cast("double") * SCALE) <= 2.0 ** 52), F.lit(False))), F.lit(False))
    good = (rows.where(fits & (F.size(vector_col) > 0))
            .select(F.col(id_col).alias("vec_id"), F.transform(y, lambda c: c + F.lit(OFFSET).cast("long")).alias("x")))
    return good.withColumn("key", F.unhex(F.md5(F.array_join(F.col("x").cast("array<string>"), ","))))


def _matrix(t: pa.Table) -> np.ndarray:
    x = t.column("x").combine_chunks()
    return x.flatten().to_numpy().reshape(len(x), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums by weight of each batch: halves of 26 bits, so that no product overflows."""
    for b in batches:
        if not b.num_rows:
            continue
        x = b.column(0).flatten().to_numpy().reshape(b.num_rows, -1)
        w, total = b.column(1).to_numpy(), [0] * x.shape[1]
        for shift, half in ((26, x >> 26), (0, x & ((1 << 26) - 1))):
            if int(np.abs(half).max()) * int(w.max()) * len(w) < 2 ** 63:
                part = (half * w[:, None]).sum(0).tolist()
            else:                                             # weights beyond 2**20 or so
                part = [sum(int(a) * int(c) for a, c in zip(col, w)) for col in half.T]
            total = [t + (int(p) << shift) for t, p in zip(total, part)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([[Decimal(t) for t in total]], pa.list_(pa.decimal128(38, 0))), pa.array([int(w.sum())], pa.int64())],
            names=["s", "n"])


def _in_order(found: DataFrame, width: int) -> tuple[np.ndarray, list]:
    """The blocks' rows (one short row each) added pairwise in the order of their
    blocks, on executors: 64 blocks to one, until few are left."""
    def add(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        total = t.column("values").combine_chunks().flatten().to_numpy().reshape(-1, width).sum(0)
        return pa.table({"block": pa.array([t.column("block")[0].as_py() >> 6], pa.int64()),
                         "values": pa.array([total], pa.list_(pa.float64()))})

    kind = "block long, values array<double>"
    blocks = found.select("block", "values")
    for _ in range(2):
        blocks = blocks.groupBy(F.shiftright("block", 6).alias("upper")).applyInArrow(add, kind)
    rows = sorted(blocks.collect(), key=lambda r: r["block"])       # blocks / 4096 rows of d x d numbers
    return np.sum([np.zeros(width)] + [np.asarray(r["values"]) for r in rows], axis=0)


def fit_list(rows: DataFrame) -> DataFrame:
    """``block, key, x, rows``: each distinct vector once, with its number of rows."""
    n_rows = rows.count()
    blocks = max(MIN_BLOCKS, n_rows // BLOCK)
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    first = lengths.first()
    size = first["d"] if first else 0
    # One digest, one vector: the vector travels once for each key and task.
    kept = rows.where(F.size("x") == size).groupBy("key").agg(F.first("x").alias("x"), F.count("*").alias("rows"))
    return materialize(kept.select(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), "key", "x", "rows"), "vectors")


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS, weights: str = "one") -> DataFrame:
    """Per row and component: ``vec_id, component, n, deviation, whitened, explained,
    identity_error``.  ``weights``: "one" fits each distinct vector once, "count" as
    often as rows hold it (n is the sum of the weights)."""
    if weights not in ("one", "count"):
        raise ValueError("weights: 'one' or 'count'")
    spark = rows.sparkSession
    good = whole_numbers(rows, id_col, vector_col)
    vectors = fit_list(good)
    w = F.lit(1).cast("long") if weights == "one" else F.col("rows")
    vectors = vectors.withColumn("w", w)
    sums = (vectors.select("x", "w").mapInArrow(_sums, "s array<decimal(38,0)>, n long")
            .select(F.posexplode("s").alias("i", "s"), "n").groupBy("i")
            .agg(F.sum("s").alias("s"), F.sum("n").alias("n")).orderBy("i").collect())
    schema = "key binary, deviation long, whitened array<double>"
    nothing = _rows(good, spark.createDataFrame([], schema), 0, np.empty(0), 0.0)
    if not sums:
        return nothing
    n, total = int(sums[0]["n"]), [int(r["s"]) for r in sums]
    d = len(total)
    mid = np.array([s // n for s in total], np.int64)
    rest = np.array([(s - n * int(m)) / n for s, m in zip(total, mid)])        # exact mean: mid + rest

    def centred(t: pa.Table) -> np.ndarray:
        return (_matrix(t) - mid).astype(np.float64) - rest

    def product(t: pa.Table) -> pa.Table:
        t = t.sort_by("key")
        y, weight = centred(t), t.column("w").to_numpy().astype(np.float64)
        return pa.table({"block": t.column("block").slice(0, 1).cast(pa.int64()),
                         "values": pa.array([((y * weight[:, None]).T @ y).ravel()], pa.list_(pa.float64()))})

    kind = "block long, values array<double>"
    cov = _in_order(vectors.groupBy("block").applyInArrow(product, kind), d * d).reshape(d, d) / n
    e, u = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(-e, kind="stable")[:components]
    trace = float(np.trace(cov))
    order = [k for k in order if e[k] > RANK * max(e[-1], 0.0)]
    if not order:
        return nothing
    e, u = e[order], u[:, order]
    u = u * np.where(u[np.abs(u).argmax(0), np.arange(u.shape[1])] < 0, -1.0, 1.0)
    project = u / np.sqrt(e)

    def out(t: pa.Table) -> pa.Table:
        y = centred(t) @ project
        z = _matrix(t) - mid                              # n * x - S = n * z - (S - n * mid)
        back = [s - n * int(m) for s, m in zip(total, mid)]
        if d * (n * (int(np.abs(z).max(initial=0)) + 1)) ** 2 < 2 ** 63:
            dev = ((z * n - np.array(back, np.int64)) ** 2).sum(1).tolist()
        else:                                             # whole numbers of any size
            dev = [sum((n * a - b) ** 2 for a, b in zip(r, back)) for r in z.tolist()]
        return pa.table({"key": t.column("key"),
                         "deviation": pa.array([v if v < 2 ** 63 else None for v in dev], pa.int64()),
                         "whitened": pa.array(list(y), pa.list_(pa.float64()))})

    def check(t: pa.Table) -> pa.Table:
        t = t.sort_by("key")
        y, weight = centred(t) @ project, t.column("w").to_numpy().astype(np.float64)
        values = np.concatenate([((y * weight[:, None]).T @ y).ravel(), weight @ y])
        return pa.table({"block": t.column("block").slice(0, 1).cast(pa.int64()),
                         "values": pa.array([values], pa.list_(pa.float64()))})

    k = len(e)
    found = vectors.groupBy("block").applyInArrow(out, schema)
    measured = _in_order(vectors.groupBy("block").applyInArrow(check, kind), k * k + k) / n
    mean = measured[k * k:]
    error = np.abs(measured[:k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max(initial=0.0)
    return _rows(good, found, n, e / trace, float(error))


def _rows(good: DataFrame, found: DataFrame, n: int, explained: np.ndarray, error: float) -> DataFrame:
    """The whitened vectors joined back to their rows, one row a component."""
    share = F.array(*(F.lit(float(v)) for v in explained)) if len(explained) else F.array().cast("array<double>")
    return (good.select("vec_id", "key").join(found, "key")
            .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    "whitened", F.get(share, F.col("at")).alias("explained"),
                    F.lit(error).alias("identity_error")))
