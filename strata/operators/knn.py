"""Exact k nearest neighbours by pairs of blocks under pivot bounds.

1. Each row gets its distances to a few pivots (far apart, chosen from a bounded
   sample).  For any pivot p, ``|d(q,p) - d(x,p)| <= d(q,x)``; several pivots give
   several such bounds, and the largest counts.
2. Rows are dealt into blocks of about ``BLOCK_ROWS``: by nearest pivot, then by rings of
   equal counts around it; a ring with too many equal distances is split by hash.  Per block
   only the least and greatest distance to each pivot are kept (``MAX_BLOCKS`` at most).
3. Round 0 compares a block with itself: the k-th distance found is each query's
   radius.  Round 1 sends each query to the ``NEAR`` nearest other blocks within its
   radius, which shrinks; the last round to all that are left within it.
4. A group of a round is one pair (block of the query, block of the candidates), so
   no task holds more than two blocks.  Within it, sub-blocks are visited nearest first under the
   same bounds, distances are screened by one matrix product with its rounding error
   allowed for, and what passes is computed exactly.

Neighbours are ordered by (squared distance, key), the row itself excluded; keys are
unique.  A table with no more than k rows raises, as do vectors of different lengths.  The driver holds pivots and block ranges, no rows but the sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.operators.model import features_matrix
from strata.session import materialize, release

#: Rows of a block, blocks at most (beyond MAX_BLOCKS * BLOCK_ROWS rows blocks grow).
BLOCK_ROWS, MAX_BLOCKS = 32_768, 4_096
#: Rows of a block of a small table.
LEAST_ROWS = 2_048
#: Pivots, and rows of the sample that they are chosen from.
PIVOTS, SAMPLE = 24, 1_024
#: Blocks that a query visits before its radius is taken again.
NEAR = 3
#: Candidates of a sub-block, and distances of one NumPy step (a few arrays of them at once).
SUB_ROWS, STEP_CELLS = 2_048, 500_000


# ------------------------------------------------------------- inside a task
def _exact(q: np.ndarray, c: np.ndarray, r: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Squared distances of the pairs (r, i), in bounded steps."""
    out = np.empty(len(r))
    step = max(1, STEP_CELLS // max(1, q.shape[1]))
    for s in range(0, len(r), step):
        out[s:s + step] = ((q[r[s:s + step]] - c[i[s:s + step]]) ** 2).sum(axis=1)
    return out


def _nearest(qx: np.ndarray, same: np.ndarray, cx: np.ndarray, ids: np.ndarray, reach: np.ndarray, k: int
             ) -> tuple[np.ndarray, np.ndarray]:
    """(queries, k) squared distances and ids of the nearest candidates within reach
    (padded with inf); ``ids`` ascend by key, ``same``: the id of the query itself or -1."""
    best, who = np.full((len(qx), k), np.inf), np.full((len(qx), k), np.iinfo(np.int64).max)
    mid = cx.mean(axis=0)
    c, c2 = cx - mid, ((cx - mid) ** 2).sum(axis=1)
    step = max(1, STEP_CELLS // len(cx))
    for s in range(0, len(qx), step):
        q = qx[s:s + step] - mid
        q2 = (q ** 2).sum(axis=1)
        near = q @ c.T                                # in place: one array of these, not four
        near *= -2.0
        near += q2[:, None]
        near += c2[None, :]
        # Rounding of the product: a few units in the last place of the squared norms, a term each.
        slack = 16 * (q.shape[1] + 8) * np.finfo(float).eps * (np.sqrt(q2) + math.sqrt(c2.max())) ** 2
        limit = reach[s:s + step] ** 2 + slack
        free = np.flatnonzero(np.isinf(limit))        # no radius yet: the k-th of these, and one for itself
        if len(free) and len(cx) > k:
            limit[free] = np.partition(near[free], k, axis=1)[:, k] + 2 * slack[free]
        r, i = np.nonzero(near <= limit[:, None])
        other = ids[i] != same[s:s + step][r]
        r, i = r[other], i[other]
        d2 = _exact(qx[s:s + step], cx, r, i)
        order = np.lexsort((ids[i], d2, r))
        r, i, d2 = r[order], i[order], d2[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        ok = place < k
        best[s + r[ok], place[ok]], who[s + r[ok], place[ok]] = d2[ok], ids[i[ok]]
    return best, who


def _gap(d: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Lower bound of the distance from rows (pivot distances ``d``) to boxes of them."""
    out = np.zeros((len(d), len(low)))
    for p in range(d.shape[1]):
        x = d[:, p, None]
        # A hair less, for the rounding of the distances themselves.
        np.maximum(out, np.maximum(low[None, :, p] - x, x - high[None, :, p]) - 1e-12 * (x + high[None, :, p]), out=out)
    return out


def block_pair(q: dict, c: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query row, candidate row and squared distance of each query's k nearest in a
    block, and how many distances were screened.  ``q``: key, x, d, reach; ``c``: key, x, d."""
    by_key = np.argsort(c["key"], kind="stable")
    ck, cx, cd = c["key"][by_key], c["x"][by_key], c["d"][by_key]
    at = np.searchsorted(ck, q["key"])
    same = np.where((at < len(ck)) & (ck[np.minimum(at, len(ck) - 1)] == q["key"]), at, -1)
    n, reach, seen = len(q["key"]), q["reach"].copy(), 0
    best, who = np.full((n, k), np.inf), np.full((n, k), np.iinfo(np.int64).max)
    spread = np.lexsort((cd[:, -1], cd[:, 0]))
    subs = [spread[s:s + SUB_ROWS] for s in range(0, len(spread), SUB_ROWS)]
    gaps = _gap(q["d"], np.array([cd[s].min(0) for s in subs]), np.array([cd[s].max(0) for s in subs]))
    for b in np.argsort(gaps.mean(axis=0), kind="stable"):
        on = np.flatnonzero(gaps[:, b] <= reach)
        if not len(on):
            continue
        ids = np.sort(subs[b])
        d2, w = _nearest(q["x"][on], same[on], cx[ids], ids, reach[on], k)
        seen += len(on) * len(ids)
        d2, w = np.concatenate([best[on], d2], 1), np.concatenate([who[on], w], 1)
        order = np.lexsort((w, d2), axis=1)[:, :k]
        best[on], who[on] = np.take_along_axis(d2, order, 1), np.take_along_axis(w, order, 1)
        reach[on] = np.minimum(reach[on], np.sqrt(best[on, -1]) * (1 + 1e-9) + 1e-9)
    r, p = np.nonzero(np.isfinite(best))
    return r, by_key[who[r, p]], best[r, p], seen


# ------------------------------------------------------------- on Spark
def choose_pivots(rows: DataFrame) -> np.ndarray:
    """Rows far from each other, of the ``SAMPLE`` first ones by hash of the key."""
    some = rows.orderBy(F.xxhash64("__k"), "__k").limit(SAMPLE).select("__x").collect()
    x = np.array([r["__x"] for r in some], float)
    chosen = [int(((x - x.mean(0)) ** 2).sum(1).argmax())]
    far = ((x - x[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(PIVOTS, len(x)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


def _with_pivots(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` plus the distances to the pivots, and which is the nearest."""
    schema = T.StructType([*rows.schema.fields, *T._parse_datatype_string(
        "__d array<double>, __home int, __r double").fields])
    where = rows.columns.index("__x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features_matrix(b.column(where), b.num_rows)
            d = np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], 1) if b.num_rows else np.empty((0, len(pivots)))
            home = d.argmin(axis=1)
            flat = pa.ListArray.from_arrays(np.arange(len(d) + 1, dtype=np.int32) * d.shape[1], d.ravel())
            yield pa.RecordBatch.from_arrays([*b.columns, flat, pa.array(home.astype(np.int32)),
                                              pa.array(d[np.arange(len(d)), home])], names=schema.names)

    return rows.mapInArrow(run, schema)


def _into_blocks(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` plus ``__block``: rings of equal counts around the nearest pivot; a
    ring with too many rows (equal distances) is split by hash."""
    size = max(min(BLOCK_ROWS, max(LEAST_ROWS, math.ceil(n / 64))), math.ceil(n / MAX_BLOCKS))
    if n <= size:
        return rows.withColumn("__block", F.lit(0))
    homes = {r["__home"]: r["n"] for r in rows.groupBy("__home").agg(F.count(F.lit(1)).alias("n")).collect()}
    rings = {h: math.ceil(m / size) for h, m in homes.items()}
    asked = [F.percentile_approx(F.when(F.col("__home") == h, F.col("__r")), [i / m for i in range(1, m)], 20 * m).alias(str(h))
             for h, m in rings.items() if m > 1]
    found = rows.agg(*asked).first().asDict() if asked else {}
    cuts = {h: np.array(sorted(set(found.get(str(h)) or []))) for h in homes}
    schema = T.StructType([*rows.schema.fields, T.StructField("__ring", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home, r = b.column("__home").to_numpy(), b.column("__r").to_numpy()
            ring = np.zeros(len(r), np.int32)
            for h in np.unique(home):
                ring[home == h] = np.searchsorted(cuts[h], r[home == h], "left")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ring)], names=schema.names)

    ringed = rows.mapInArrow(run, schema)
    per = ringed.groupBy("__home", "__ring").agg(F.count(F.lit(1)).alias("n")).orderBy("__home", "__ring").collect()
    first, table = 0, []
    for r in per:
        parts = math.ceil(r["n"] / size)
        table.append((r["__home"], r["__ring"], first, parts))
        first += parts
    spread = rows.sparkSession.createDataFrame(table, "__home int, __ring int, __first int, __parts int")
    return (ringed.join(spread, ["__home", "__ring"])
            .withColumn("__block", (F.col("__first") + F.pmod(F.xxhash64("__k"), F.col("__parts"))).cast("int")))


def _column(t: pa.Table, name: str, n: int | None = None) -> np.ndarray:
    col = t.column(name)
    if n is None:
        return col.to_numpy()
    return features_matrix(col.combine_chunks(), t.num_rows)


def _side(t: pa.Table, prefix: str = "__") -> dict:
    return {"key": _column(t, prefix + "k"), "x": _column(t, prefix + "x", 1), "d": _column(t, prefix + "d", 1)}


def knn(df: DataFrame, key: str, features: str = "features", k: int = 5, n: int | None = None,
        screened=None) -> DataFrame:
    """Exact k nearest neighbours inside ``df`` (self excluded), as rows
    ``(key, nbr_rank, nbr_key, d2)`` ordered by (squared distance, key).

    ``screened``: a Spark accumulator that the tasks add the number of distances
    to which they took (a retried task adds again)."""
    n = df.count() if n is None else n
    if n <= k:
        raise ValueError(f"need more than k={k} rows for k nearest neighbours, got {n}")
    key_type = df.schema[key].dataType
    given = getattr(df, "_materialized_at", None)
    written = df if given else materialize(df.select(key, features), "knn-rows")
    rows = written.select(F.col(key).alias("__k"), F.col(features).alias("__x"))
    base = materialize(_into_blocks(_with_pivots(rows, choose_pivots(rows)), n)
                       .select("__k", "__x", "__d", "__block"), "knn-blocks")
    if not given:
        release(written)
    found_type = T.StructType([T.StructField("__k", key_type), T.StructField("nbr_key", key_type),
                               T.StructField("d2", T.DoubleType())])
    names = found_type.names

    def result(q: dict, c: dict) -> pa.Table:
        r, i, d2, seen = block_pair(q, c, k)
        if screened is not None:
            screened.add(int(seen))
        return pa.table([pa.array(q["key"][r]), pa.array(c["key"][i]), pa.array(d2)], names=names)

    def own(t: pa.Table) -> pa.Table:
        c = _side(t)
        return result({**c, "reach": np.full(t.num_rows, np.inf)}, c)

    def pair(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return pa.table([pa.array([], f.type) for f in to_arrow_schema(found_type)], names=names)
        return result({**_side(q), "reach": _column(q, "__reach")}, _side(c))

    def best_of(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("__k").orderBy("d2", "nbr_key")
        return found.withColumn("__rank", F.row_number().over(w) - 1).where(F.col("__rank") < k)

    found = base.groupBy("__block").applyInArrow(own, found_type)
    width = base.select(F.size("__d")).first()[0]
    box = [f(F.get("__d", F.lit(p))).alias(f"{f.__name__}{p}") for p in range(width) for f in (F.min, F.max)]
    boxes = base.groupBy("__block").agg(*box).orderBy("__block").collect()
    if len(boxes) > 1:
        ids = np.array([r["__block"] for r in boxes], np.int32)
        low, high = (np.array([[r[f"{f}{p}"] for p in range(width)] for r in boxes]) for f in ("min", "max"))
        found = materialize(found, "knn-round")
        for last in (False, True):
            asked = _asked(base, found, k, ids, low, high, last)
            pairs = asked.groupBy("__block", "__to").agg(F.lit(1).alias("__one")).select(
                F.col("__block").alias("__from"), F.col("__to").alias("__at"))
            held = base.withColumnRenamed("__block", "__b").join(pairs, F.col("__b") == F.col("__at")).select(
                "__from", "__at", "__k", "__x", "__d")
            new = (asked.groupBy("__block", "__to").cogroup(held.groupBy("__from", "__at"))
                   .applyInArrow(pair, found_type))
            merged = materialize(best_of(found.unionByName(new)).drop("__rank"), "knn-round")
            release(found)
            found = merged
    return best_of(found).select(F.col("__k").alias(key), F.col("__rank").cast("int").alias("nbr_rank"), "nbr_key", "d2")


def _asked(base: DataFrame, found: DataFrame, k: int, ids: np.ndarray, low: np.ndarray, high: np.ndarray,
           last: bool) -> DataFrame:
    """One row for each query and other block within its radius: the nearest
    ``NEAR`` of them, or (``last``) the rest."""
    radius = found.groupBy(F.col("__k").alias("__q")).agg(F.count(F.lit(1)).alias("__n"), F.max("d2").alias("__m"))
    reach = F.coalesce(F.when(F.col("__n") >= k, F.sqrt("__m") * (1 + 1e-9) + 1e-9), F.lit(math.inf))
    rows = base.join(radius, F.col("__k") == F.col("__q"), "left").select("__k", "__x", "__d", "__block", reach.alias("__reach"))
    schema = T.StructType([*rows.schema.fields, T.StructField("__tos", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = features_matrix(b.column("__d"), b.num_rows)
            mine, within = b.column("__block").to_numpy(), b.column("__reach").to_numpy()
            out = []
            for s in range(0, len(d), 512):
                gap = _gap(d[s:s + 512], low, high)
                gap[ids[None, :] == mine[s:s + 512, None]] = np.inf
                order = np.argsort(gap, axis=1, kind="stable")
                for r, o in enumerate(order):
                    chosen = o[NEAR:] if last else o[:NEAR]     # that order does not depend on the radius
                    out.append(ids[chosen[(gap[r, chosen] <= within[s + r]) & np.isfinite(gap[r, chosen])]].tolist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.int32()))], names=schema.names)

    return rows.mapInArrow(run, schema).select(*rows.columns, F.explode("__tos").alias("__to"))
