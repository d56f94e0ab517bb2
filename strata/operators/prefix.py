"""Quantile of all earlier values, for every row of an ordered table of any size.

A window with a growing frame sorts a whole group in one task.  Here rows are
numbered in their order and cut into blocks of ``BLOCK`` arrivals; a task takes one block.

Within a block the wanted order statistic of the earlier rows moves by at most the
rows of the block, so a block needs only the earlier values of a narrow range of
ranks.  Values are dealt into buckets by quantiles of all of them (each cut value is a bucket
of its own, so a value that a third of all rows share is one count and never
fetched row by row).  Counts by (block, bucket), summed over the earlier blocks, tell
which buckets hold that range and how many values lie below it; the values of those buckets
alone are joined to the block, which then merges them with its own rows as they arrive.

Quantiles interpolate linearly between neighbours, null before the first value; null
values get a quantile but count for none.  The driver holds cut values (``MAX_CUTS``)
and one count for each partition and bucket, no rows.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.session import materialize, release

#: Rows of a block; cut values at most.
BLOCK, MAX_CUTS = 4_096, 32_768


class Merged:
    """Order statistics of earlier values (a sorted range of them, ``skip`` lie below)
    and of those that have arrived since."""

    def __init__(self, values: np.ndarray, skip: int):
        self.old, self.skip, self.new = values, skip, []

    def add(self, value: float) -> None:
        bisect.insort(self.new, value)

    def kth(self, k: int) -> float:
        """The k-th smallest (from 0) of all."""
        k -= self.skip
        low, high = max(0, k + 1 - len(self.old)), min(k + 1, len(self.new))
        while low < high:                      # how many of the k + 1 smallest are new
            i = (low + high) // 2
            if i < len(self.new) and k - i >= 0 and self.old[k - i] > self.new[i]:
                low = i + 1
            else:
                high = i
        tail = [self.new[low - 1]] if low else []
        if k + 1 - low:
            tail.append(float(self.old[k - low]))
        return max(tail)

    def quantile(self, q: float, n: int) -> float | None:
        """Of the ``n`` values so far, with linear interpolation."""
        if not n:
            return None
        at = q * (n - 1)
        a = math.floor(at)
        x = self.kth(a)
        return x if at == a else x + (at - a) * (self.kth(a + 1) - x)


def _numbered(df: DataFrame, order: str) -> DataFrame:
    """``df`` plus ``__pos``: place in the order, from 0 (one count a partition on the driver)."""
    laid = df.repartitionByRange(order).sortWithinPartitions(order).withColumn("__id", F.monotonically_increasing_id())
    laid = materialize(laid, "arrivals")
    per = laid.groupBy(F.shiftright("__id", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts = np.cumsum([0] + [r["n"] for r in per]).tolist()
    table = df.sparkSession.createDataFrame([(r["part"], s) for r, s in zip(per, starts)], "__part long, __start long")
    return (laid.withColumn("__part", F.shiftright("__id", 33)).join(F.broadcast(table), "__part")
            .withColumn("__pos", F.col("__start") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("__part", "__start", "__id"))


def _bucketed(df: DataFrame, cuts: np.ndarray) -> DataFrame:
    """``df`` plus ``__bucket`` of ``__v``: odd for a cut value itself, even between two."""
    schema = T.StructType([*df.schema.fields, T.StructField("__bucket", T.IntegerType())])
    where = df.columns.index("__v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(where).to_numpy(zero_copy_only=False).astype(float)
            bucket = np.searchsorted(cuts, v, "left") + np.searchsorted(cuts, v, "right")
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(bucket.astype(np.int32), mask=np.isnan(v))], names=schema.names)

    return df.mapInArrow(run, schema)


def prefix_quantile(df: DataFrame, order: str, value: str, q: float, out: str = "quantile", n: int | None = None) -> DataFrame:
    """``df`` plus ``out``: the ``q`` quantile of ``value`` over the rows before each in
    ``order`` (unique).  ``n``: the number of rows, or a bound of it; at most ``BLOCK`` rows
    are one block and need none of the counts."""
    n = df.count() if n is None else n
    plain = [f for f in df.schema.fields]
    schema = T.StructType([*plain, T.StructField(out, T.DoubleType())])
    arrow, names = to_arrow_schema(schema), [f.name for f in plain]

    def merged(t: pa.Table, values: np.ndarray, skip: int, before: int) -> pa.Table:
        t = t.sort_by(order)
        state, count, found = Merged(values, skip), before, []
        for v in t.column(value).to_pylist():
            found.append(state.quantile(q, count))
            if v is not None:
                state.add(float(v))
                count += 1
        return pa.table([*(t.column(c) for c in names), pa.array(found, pa.float64())], names=schema.names).cast(arrow)

    if n <= BLOCK:
        return df.groupBy(F.lit(0).alias("__one")).applyInArrow(
            lambda t: merged(t, np.empty(0), 0, 0), schema)

    rows = _numbered(df, order).withColumn("__v", F.col(value).cast("double")).withColumn(
        "__block", F.floor(F.col("__pos") / BLOCK))
    m = min(MAX_CUTS, math.ceil(n / BLOCK) * 4)
    cuts = np.unique(rows.agg(F.percentile_approx("__v", [i / m for i in range(1, m)], 10 * m)).first()[0] or [])
    rows = materialize(_bucketed(rows, cuts), "arrivals")
    n_buckets = 2 * len(cuts) + 1

    # Counts by (block, bucket), and before each block; every block has every bucket.
    counts = rows.where("__bucket is not null").groupBy("__block", "__bucket").agg(F.count(F.lit(1)).alias("c"))
    every = rows.select("__block").distinct().select("__block", F.explode(F.sequence(F.lit(0), F.lit(n_buckets - 1))).alias("__bucket"))
    earlier = Window.partitionBy("__bucket").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = (every.join(counts, ["__block", "__bucket"], "left")
              .select("__block", "__bucket", F.coalesce("c", F.lit(0)).alias("own"),
                      F.coalesce(F.sum(F.coalesce("c", F.lit(0))).over(earlier), F.lit(0)).alias("n")))

    def wanted(t: pa.Table) -> pa.Table:
        """Buckets that hold the ranks which the block can ask for."""
        t = t.sort_by("__bucket")
        c, own = t.column("n").to_numpy(), int(t.column("own").to_numpy().sum())
        total, ends = int(c.sum()), np.cumsum(t.column("n").to_numpy())
        low = max(0, math.floor(q * (total - 1)) - own - 1)
        high = min(total - 1, math.ceil(q * (total + own)) + 1)
        a, z = int(np.searchsorted(ends, low, "right")), int(np.searchsorted(ends, high, "right"))
        some = np.arange(a, min(z, len(c) - 1) + 1) if total else np.empty(0, int)
        some = some[c[some] > 0]
        k = max(1, len(some))                        # a block without earlier values stays, with no bucket
        return pa.table({"__block": pa.array([t.column("__block")[0].as_py()] * k, pa.int64()),
                         "__bucket": pa.array(some.tolist() or [None], pa.int32()),
                         "__held": pa.array(c[some].tolist() or [0], pa.int64()),
                         "__skip": pa.array([int(ends[a - 1]) if a else 0] * k, pa.int64()),
                         "__before": pa.array([total] * k, pa.int64())})

    asked = materialize(before.groupBy("__block").applyInArrow(
        wanted, "__block long, __bucket int, __held long, __skip long, __before long"), "asked")
    # A cut value's bucket is its count; the values of the others are fetched from earlier blocks.
    known = asked.where("__bucket % 2 = 1").select(
        "__block", F.element_at(F.array(*[F.lit(float(c)) for c in cuts]), F.floor(F.col("__bucket") / 2).cast("int") + 1).alias("__w"),
        F.col("__held").alias("__times")) if len(cuts) else None
    values = rows.groupBy(F.col("__block").alias("__from"), "__bucket", F.col("__v").alias("__w")).agg(F.count(F.lit(1)).alias("__times"))
    fetched = (asked.where("__bucket % 2 = 0").select("__block", "__bucket").join(values, "__bucket")
               .where(F.col("__from") < F.col("__block")).select("__block", "__w", "__times"))
    older = fetched.unionByName(known) if known is not None else fetched
    base = asked.groupBy("__block").agg(F.first("__skip").alias("__skip"), F.first("__before").alias("__before"))
    older = older.unionByName(base.select("__block", F.lit(None).cast("double").alias("__w"), F.lit(0).cast("long").alias("__times")))
    older = older.join(base.withColumnRenamed("__block", "__b"), F.col("__block") == F.col("__b")).drop("__b")

    def block(t: pa.Table, o: pa.Table) -> pa.Table:
        if not t.num_rows:
            return arrow.empty_table()
        w, times = o.column("__w").to_numpy(), o.column("__times").to_numpy()
        real = times > 0
        at = np.argsort(w[real], kind="stable")
        return merged(t, np.repeat(w[real][at], times[real][at]), o.column("__skip")[0].as_py(), o.column("__before")[0].as_py())

    found = rows.select(*names, "__block").groupBy("__block").cogroup(older.groupBy("__block")).applyInArrow(block, schema)
    found = materialize(found, "quantiles")
    release(rows)
    release(asked)
    return found
