"""Min-max scaling, label encoding, drop-first dummies, one-hot labels.

Fitting is a small aggregate job whose result (a handful of numbers, or the
sorted level list of a column that becomes dummies) is held by a model object and can
be exported as a table and re-applied to new data (unlike a re-fitted
encoder whose mapping is lost).  Applying is a pure projection: fitted
values are inlined as literals, so the plan stays one codegen stage with no
join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.vectors import one_hot

#: Widest column that becomes 0/1 columns (C4) or an inlined level list; label
#: codes (C3) have no such limit.
MAX_WIDTH = 4096


# ---------------------------------------------------------------- min-max

@dataclass
class MinMaxModel:
    """Per-column (min, max); ``apply`` maps x to (x-min)/(max-min), with a
    constant column mapped to 0.0 and null kept null."""

    stats: dict[str, tuple[float | None, float | None]]

    def expr(self, c: str):
        """The scaled value of column ``c`` as an expression."""
        lo, hi = self.stats[c]
        x = F.col(c).cast("double")
        if lo is None:
            return F.lit(None).cast("double")
        if hi == lo:
            return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
        return (x - F.lit(float(lo))) / F.lit(float(hi) - float(lo))

    def apply(self, df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
        return df.withColumns({c: self.expr(c) for c in (cols or list(self.stats))})

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(c, lo, hi) for c, (lo, hi) in self.stats.items()]
        return spark.createDataFrame(rows, "column string, min double, max double")

    @classmethod
    def from_df(cls, stats_df: DataFrame) -> "MinMaxModel":
        return cls({r["column"]: (r["min"], r["max"]) for r in stats_df.collect()})


def minmax_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C1 as a table: one row with ``min_<c>`` and ``max_<c>`` for each column.
    A single global aggregate; partial min/max run map-side."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"min_{c}"), F.max(x).alias(f"max_{c}")]
    return df.agg(*aggs)


def minmax_fit(df: DataFrame, cols: Sequence[str]) -> MinMaxModel:
    """Fit (one small job, one row back)."""
    row = minmax_stats(df, cols).collect()[0]
    return MinMaxModel({c: (row[f"min_{c}"], row[f"max_{c}"]) for c in cols})


def minmax_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None
                 ) -> DataFrame:
    """C1+C2: fit on ``fit_on`` (default: ``df`` itself) and apply to ``df``."""
    return minmax_fit(fit_on if fit_on is not None else df, cols).apply(df, cols)


# ---------------------------------------------------------------- categories

@dataclass
class LabelEncoderModel:
    """Sorted distinct non-null levels per column; code = index in that list."""

    levels: dict[str, list] = field(default_factory=dict)

    def code(self, c: str):
        lv = self.levels[c]
        if not lv:
            return F.lit(None).cast("int")
        pos = F.array_position(F.array(*[F.lit(v) for v in lv]), F.col(c))
        return F.when(pos > 0, (pos - 1).cast("int"))

    def encode(self, df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
        """Replace each column by its integer code (unseen/null -> null)."""
        return df.withColumns({c: self.code(c) for c in (cols or list(self.levels))})

    def dummies(self, df: DataFrame, cols: Sequence[str] | None = None,
                drop_first: bool = True, encoded: bool = False) -> DataFrame:
        """C4: replace each column by 0/1 columns ``<col>_<code>`` appended at
        the right end, one per level, without the first when ``drop_first``.
        ``encoded`` says the column already holds codes (after ``encode``)."""
        cols = list(cols or self.levels)
        new = {}
        for c in cols:
            start = 1 if drop_first else 0
            for j in range(start, len(self.levels[c])):
                # code == j  <=>  value == levels[j]: one comparison per column
                hit = (F.col(c) == F.lit(j)) if encoded else \
                    (F.col(c) == F.lit(self.levels[c][j]))
                new[f"{c}_{j}"] = F.coalesce(hit.cast("int"), F.lit(0))
        keep = [x for x in df.columns if x not in cols]
        return df.select(*keep, *[v.alias(k) for k, v in new.items()])

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(c, str(v), i) for c, lv in self.levels.items() for i, v in enumerate(lv)]
        return spark.createDataFrame(rows, "column string, level string, code int")


def _melted(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The distinct non-null values of all columns in one table and one scan:
    ``col`` (its place in ``cols``) and a value column for each type among them (the others
    null), so that values keep their type and order.  Also each column's value column."""
    kinds = [df.schema[c].dataType for c in cols]
    names = {k: f"v{i}" for i, k in enumerate(dict.fromkeys(kinds))}
    rows = F.array(*[
        F.struct(F.lit(i).alias("col"),
                 *[(F.col(c) if k == kinds[i] else F.lit(None).cast(k)).alias(n) for k, n in names.items()])
        for i, c in enumerate(cols)])
    tall = df.select(*dict.fromkeys(cols)).select(F.inline(rows))
    some = F.lit(False)
    for n in names.values():
        some = some | F.col(n).isNotNull()
    return tall.where(some).distinct(), [names[k] for k in kinds]


def label_encoder_fit(df: DataFrame, cols: Sequence[str],
                      max_width: int = MAX_WIDTH) -> LabelEncoderModel:
    """C3 fit for dummies: the sorted distinct non-null values of each column,
    in the column's own type and Spark's order of it; one scan for all columns.

    The values become columns or literals, so at most ``max_width`` of one
    column come to the driver; a wider column raises (``label_encode`` takes any)."""
    from strata.session import materialize, release
    cols = list(cols)
    if not cols:
        return LabelEncoderModel({})
    found, names = _melted(df, cols)
    found = materialize(found, "levels")
    for r in found.groupBy("col").count().collect():
        if r["count"] > max_width:
            raise ValueError(f"column {cols[r['col']]} has more than {max_width} levels")
    rows = found.orderBy("col", *dict.fromkeys(names)).collect()      # at most len(cols) * max_width
    release(found)
    return LabelEncoderModel({c: [r[names[i]] for r in rows if r["col"] == i] for i, c in enumerate(cols)})


@dataclass
class LevelTable:
    """C3 fit of some columns as one written table ``(col, <value columns>, code)``."""

    table: DataFrame
    cols: list[str]
    names: list[str]           # value column of each
    counts: list[int]          # levels of each

    def of(self, i: int) -> DataFrame:
        return self.table.where(F.col("col") == i).select(
            F.col(self.names[i]).alias("level"), "code")


def level_tables(df: DataFrame, cols: Sequence[str]) -> LevelTable:
    """C3 fit of any number of columns and levels with one scan, one distinct and one
    range sort: a code is the level's place among its column's rows of a partition
    plus those of the partitions before it (one number for each partition and
    column reaches the driver)."""
    from strata.session import materialize
    spark, cols = df.sparkSession, list(cols)
    found, names = _melted(df, cols)
    keys = ["col", *dict.fromkeys(names)]
    placed = materialize(found.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .select(*keys, F.monotonically_increasing_id().alias("id")), "levels").select(
        *keys, F.shiftright("id", 33).alias("part"), F.col("id").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    per = placed.groupBy("part", "col").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).collect()
    before, base = [0] * len(cols), []
    for r in sorted(per, key=lambda r: (r["part"], r["col"])):
        base.append((r["part"], r["col"], before[r["col"]] - r["first"]))
        before[r["col"]] += r["n"]
    offsets = spark.createDataFrame(base, "part long, col int, shift long")
    table = placed.join(F.broadcast(offsets), ["part", "col"]).select(
        *keys, (F.col("shift") + F.col("place")).alias("code"))
    return LevelTable(table, cols, names, before)


def level_table(df: DataFrame, col: str) -> DataFrame:
    """C3 fit of one column as a table ``(level, code)`` of any size."""
    return level_tables(df, [col]).of(0)


#: A level table of at most so many rows is sent to every executor.
BROADCAST_LEVELS = 100_000


def label_encode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace each column by the rank of its value among the column's
    sorted distinct values (null stays null).  Any type and any number of
    levels: all columns are fitted in one scan; a level table of at most
    ``BROADCAST_LEVELS`` rows (counted) is broadcast, a larger one joined by shuffle."""
    cols = list(cols)
    if not cols:
        return df
    levels, out = level_tables(df, cols), df
    for i, c in enumerate(cols):
        lv = levels.of(i).select(F.col("level").alias("__level"), F.col("code").cast("int").alias("__code"))
        if levels.counts[i] <= BROADCAST_LEVELS:
            lv = F.broadcast(lv)
        out = out.join(lv, F.col(c) == F.col("__level"), "left").withColumn(
            c, F.col("__code")).drop("__level", "__code")
    return out


def get_dummies(df: DataFrame, cols: Sequence[str], drop_first: bool = True) -> DataFrame:
    """C3 + C4 as one projection."""
    return label_encoder_fit(df, cols).dummies(df, cols, drop_first=drop_first)


def one_hot_label(df: DataFrame, label: str, levels: Sequence | None = None,
                  out_col: str | None = None) -> DataFrame:
    """Full-width one-hot array of the label; unseen values -> all zeros."""
    if levels is None:
        levels = label_encoder_fit(df, [label]).levels[label]
    return df.withColumn(out_col or f"{label}_onehot", one_hot(F.col(label), levels))
