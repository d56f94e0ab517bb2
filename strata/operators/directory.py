"""Rows by position from a stored rank directory.

``RankDirectory.write`` stores a table once in the order of ``(md5(seed:key), key)``: rows
sorted by digest, in folders by the first byte of it, with their bucket (the first two bytes),
and next to them one count a bucket (65,536 at most, whatever the table).  A position
is then found without the table: its bucket by the running sum of the counts, its rank
within the bucket by what is left, and the rows by a filter on folder and bucket that reaches
the Parquet reader (folders are pruned, and within a file the row groups by the
buckets they hold).  Fetching a few rows so reads a few buckets.

Null keys fail, as everywhere; two rows of one key fail the fetch that meets their bucket.
Listed positions outside the table raise, those of a table find nothing; a position asked for twice comes twice; a table of
positions (any number) is joined by its buckets, which reads those buckets.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.hashing import as_list
from strata.operators.rank import BUCKET_DIGITS, DUPLICATE_MESSAGE, HASH, with_hash

#: Positions of one list; more are given as a table.
MAX_LISTED = 1_000
FOLDER, BUCKET = "__p", "__b"


class RankDirectory:
    """A table stored for access by position."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType | None = None):
        self.spark, self.path, self.keys = spark, path, as_list(keys)
        self.rows = (spark.read.schema(schema) if schema else spark.read).parquet(f"{path}/rows")
        counts = {r[BUCKET]: r["n"] for r in spark.read.parquet(f"{path}/counts").collect()}
        self.buckets = sorted(counts)
        self.ends = list(accumulate(counts[b] for b in self.buckets))

    @classmethod
    def write(cls, df: DataFrame, key: str | Sequence[str], seed: object, path: str, *salt: object) -> "RankDirectory":
        """Store ``df``: one range partitioning by digest, one write, one count."""
        keys = as_list(key)
        number = F.conv(F.substring(HASH, 1, BUCKET_DIGITS), 16, 10).cast("int")
        laid = (with_hash(df, keys, seed, *salt).withColumn(BUCKET, number)
                .withColumn(FOLDER, F.floor(F.col(BUCKET) / 256).cast("int")))
        (laid.repartitionByRange(FOLDER, HASH).sortWithinPartitions(FOLDER, HASH, *keys)
         .write.partitionBy(FOLDER).parquet(f"{path}/rows"))
        stored = df.sparkSession.read.schema(laid.schema).parquet(f"{path}/rows")
        stored.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.parquet(f"{path}/counts")
        return cls(df.sparkSession, path, keys, laid.schema)

    def __len__(self) -> int:
        return self.ends[-1] if self.ends else 0

    def _ranked(self, some: DataFrame) -> DataFrame:
        """Rows of whole buckets with their place (from 0) in the bucket."""
        w = Window.partitionBy(BUCKET).orderBy(HASH, *self.keys)
        twice = F.coalesce(F.lag(HASH).over(w) == F.col(HASH), F.lit(False))
        return some.withColumn("__place", F.when(twice, F.raise_error(F.lit(DUPLICATE_MESSAGE)).cast("long"))
                               .otherwise((F.row_number().over(w) - 1).cast("long")))

    def _out(self, found: DataFrame) -> DataFrame:
        return found.drop("__place", HASH, BUCKET, FOLDER)

    def fetch(self, positions: Sequence[int] | DataFrame, pos_col: str = "pos") -> DataFrame:
        """Rows at 0-based positions, with ``pos_col`` and ``request`` (the place in the
        list; a table has both columns itself)."""
        if isinstance(positions, DataFrame):
            return self._fetch_table(positions, pos_col)
        asked = [int(p) for p in positions]
        if len(asked) > MAX_LISTED:
            raise ValueError(f"more than {MAX_LISTED} positions: give them as a table")
        if any(not 0 <= p < len(self) for p in asked):
            raise IndexError(f"positions lie in 0 .. {len(self) - 1}")
        rows = []
        for i, p in enumerate(asked):
            k = bisect.bisect_right(self.ends, p)
            rows.append((i, p, self.buckets[k], p - (self.ends[k - 1] if k else 0)))
        wanted = self.spark.createDataFrame(rows, f"request long, {pos_col} long, {BUCKET} int, __place long")
        within = F.lit(False)
        for b in sorted({r[2] for r in rows}):            # equalities, not IN: the reader takes each of them
            within = within | (F.col(BUCKET) == b)
        some = self.rows.where(F.col(FOLDER).isin(sorted({r[2] // 256 for r in rows})) & within)
        return self._out(self._ranked(some).join(F.broadcast(wanted), [BUCKET, "__place"]))

    def _fetch_table(self, positions: DataFrame, pos_col: str) -> DataFrame:
        """The buckets of asked positions: a join with the table of bucket ranges, by
        equality on steps of positions, then by range."""
        starts = [0, *self.ends[:-1]] if self.ends else []
        table = self.spark.createDataFrame(list(zip(self.buckets, starts, self.ends)),
                                           f"{BUCKET} int, __from long, __end long")
        step = max(1, len(self) // 4096)
        spread = table.withColumn("__step", F.explode(F.sequence(
            F.floor(F.col("__from") / step), F.floor((F.col("__end") - 1) / step))))
        asked = positions.select("request", F.col(pos_col).cast("long").alias(pos_col))
        placed = (asked.withColumn("__step", F.floor(F.col(pos_col) / step)).join(spread, "__step")
                  .where((F.col(pos_col) >= F.col("__from")) & (F.col(pos_col) < F.col("__end")))
                  .select("request", pos_col, BUCKET, (F.col(pos_col) - F.col("__from")).alias("__place")))
        some = self.rows.join(placed.select(BUCKET).distinct(), BUCKET, "left_semi")
        return self._out(self._ranked(some).join(placed, [BUCKET, "__place"]))
