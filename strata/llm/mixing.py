"""Mixing sources to target weights by systematic sampling (operator 9).

Every document of a source has the same expected number of copies,
``rate = target words / source words``.  Within a source the documents stand
in the order (words, md5 of id and text); the prefix sum of expected copies of the
document at rank i is ``i * rate``, shifted by one random offset of the
source; the document is emitted once per integer boundary that its interval
crosses, so ``floor(rate)`` or ``ceil(rate)`` times.  Because neighbours in the
order have about equal sizes, the words taken stay near the target.  Of the
``DRAWS`` offsets that the seed draws for a source, the one is used whose words
taken come nearest its target: documents of one size are neighbours, so that
follows from the counts per size alone.

Ranks need no global sort: counts per (source, size) and per 4,096 md5 slots
within them are pre-aggregated, their prefix sums place each slot, and only the
rows of one slot are ordered together.  A source with a third of all rows, or a
third of all rows of one size, is so spread over thousands of slots.

Defined results: null and empty texts have size 0 (and are copied like any
other); a null source is a source of its own, last in order; repeated rows are
separate documents (of rows equal in id, text and source the first ones by the hash of all
columns are taken, whatever the partitioning); an empty table gives an empty result; extra columns pass
through ``mix`` untouched (names starting with ``_mix_`` are reserved).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: The mix keeps one rate per source on the driver; refuse tables where
#: "source" is not a source but close to a row id.
MAX_SOURCES = 1_000_000
DRAWS = 8


def size_of(text: str) -> F.Column:
    """Words of the text (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict, cycle: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> dict:
    """Target words of each source: 100% of all words by weight, at most ``cap``
    times the source's own; what is above is shared again until none is above.

    ``sizes`` maps a source (None allowed) to its words.
    """
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(order)}
    left, free, out = sum(sizes.values()), list(order), {}
    while free:
        share = sum(weight[s] for s in free)
        above = [s for s in free if weight[s] * left > cap * sizes[s] * share]
        if not above:
            out |= {s: (weight[s] * left) / share for s in free}
            break
        for s in above:
            out[s] = float(cap * sizes[s])
            left -= cap * sizes[s]
            free.remove(s)
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", size: F.Column | None = None, seed: int = 1,
        cycle: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``docs`` plus ``_mix_size, _mix_source_size, _mix_target, _mix_copies``."""
    spark = docs.sparkSession
    # Id and text place a row, so null and repeated ids spread; then all its columns.
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"),
                         F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    whole = F.xxhash64(*(F.col(f.name) for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)))
    df = docs.withColumns({"_mix_size": size_of(text_col) if size is None else size,
                           "_mix_key": key, "_mix_slot": F.substring(key, 1, 3), "_mix_whole": whole})
    src = F.col(source_col).alias("_mix_source")
    # counts only; written, as targets, offsets and ranks all come from them
    slots = materialize(df.select(src, "_mix_size", "_mix_slot").groupBy(
        "_mix_source", "_mix_size", "_mix_slot").agg(F.count("*").alias("_mix_n")), "mix-slots")
    per_source = (slots.groupBy("_mix_source").agg(
        F.sum(F.col("_mix_size") * F.col("_mix_n")).alias("words"))
                  .limit(MAX_SOURCES + 1).collect())
    if len(per_source) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    words = {r["_mix_source"]: r["words"] for r in per_source}
    target = targets(words, cycle, cap)
    rates = spark.createDataFrame(
        [(s, w, float(target[s]), float(target[s]) / w if w else 1.0) for s, w in words.items()],
        f"_mix_rsource {dict(docs.dtypes)[source_col]}, _mix_source_size long, "
        "_mix_target double, _mix_rate double")

    by_size = slots.groupBy("_mix_source", "_mix_size").agg(F.sum("_mix_n").alias("_mix_n"))
    w1 = Window.partitionBy("_mix_source").orderBy("_mix_size").rowsBetween(
        Window.unboundedPreceding, -1)
    w2 = Window.partitionBy("_mix_source", "_mix_size").orderBy("_mix_slot").rowsBetween(
        Window.unboundedPreceding, -1)
    before_size = by_size.select(
        F.col("_mix_source").alias("_mix_s1"), F.col("_mix_size").alias("_mix_z1"),
        F.coalesce(F.sum("_mix_n").over(w1), F.lit(0)).alias("_mix_b1"), "_mix_n")
    edge = lambda i, u: F.floor(i * F.col("_mix_rate") + u)
    draws = [F.conv(F.substring("_mix_draw", 4 * k + 1, 4), 16, 10).cast("double") / 65536.0
             for k in range(DRAWS)]
    rates = rates.withColumn("_mix_draw", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(
        F.concat(F.lit("s"), F.col("_mix_rsource").cast("string")), F.lit("n")))))
    # Words taken under each offset, and how far from the target.
    off = [F.abs(F.sum(F.col("_mix_z1") * (edge(F.col("_mix_b1") + F.col("_mix_n"), u)
                                           - edge(F.col("_mix_b1"), u))) - F.first("_mix_target")) for u in draws]
    best = (before_size.join(F.broadcast(rates), F.col("_mix_s1").eqNullSafe(F.col("_mix_rsource")))
            .groupBy("_mix_rsource", "_mix_source_size", "_mix_target", "_mix_rate", "_mix_draw")
            .agg(F.array(*off).alias("_mix_off")))
    rates = best.withColumn("_mix_u", F.get(F.array(*draws), F.array_position(
        "_mix_off", F.array_min("_mix_off")).cast("int") - 1)).drop("_mix_off", "_mix_draw")
    before_size = before_size.drop("_mix_n")
    before = (slots.withColumn("_mix_b2", F.coalesce(F.sum("_mix_n").over(w2), F.lit(0)))
              .join(before_size, F.col("_mix_source").eqNullSafe(F.col("_mix_s1"))
                    & (F.col("_mix_size") == F.col("_mix_z1")))
              .select(F.col("_mix_source").alias("_mix_s2"), F.col("_mix_size").alias("_mix_z2"),
                      F.col("_mix_slot").alias("_mix_l2"),
                      (F.col("_mix_b1") + F.col("_mix_b2")).alias("_mix_before")))
    cell = Window.partitionBy(F.col(source_col), "_mix_size", "_mix_slot").orderBy("_mix_key", "_mix_whole")
    rank = F.col("_mix_before") + F.row_number().over(cell) - 1
    return (df.join(before, F.col(source_col).eqNullSafe(F.col("_mix_s2"))
                    & (F.col("_mix_size") == F.col("_mix_z2"))
                    & (F.col("_mix_slot") == F.col("_mix_l2")))
            .join(F.broadcast(rates), F.col(source_col).eqNullSafe(F.col("_mix_rsource")))
            .withColumn("_mix_rank", rank)
            .withColumn("_mix_copies", (
                edge(F.col("_mix_rank") + 1, F.col("_mix_u")) - edge(F.col("_mix_rank"), F.col("_mix_u"))).cast("int"))
            .drop("_mix_key", "_mix_slot", "_mix_whole", "_mix_s2", "_mix_z2", "_mix_l2", "_mix_before",
                  "_mix_rsource", "_mix_rate", "_mix_u", "_mix_rank"))


def mixed_docs(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` repeated as often as it is taken."""
    out = mix(docs, **options).where("_mix_copies > 0")
    return (out.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), "_mix_copies")))
            .select(*docs.columns))


#: DuckDB: the same mix over the documents table.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight,
         md5('1:' || coalesce('s' || source, 'n')) AS draw
  FROM d GROUP BY source
), o AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * words / weight, source NULLS LAST) AS pos,
         (SELECT sum(words) FROM s) - coalesce(sum(3 * words) OVER (
             ORDER BY 3.0 * words / weight, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remain,
         sum(weight) OVER (ORDER BY 3.0 * words / weight, source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM s
), f AS (SELECT min(pos) AS pos FROM o WHERE weight * remain <= 3 * words * share),
r AS (
  SELECT o.source, o.words, o.draw,
         CASE WHEN f.pos IS NULL OR o.pos < f.pos THEN CAST(3 * o.words AS DOUBLE)
              ELSE CAST(o.weight * b.remain AS DOUBLE) / CAST(b.share AS DOUBLE) END AS target
  FROM o CROSS JOIN f LEFT JOIN o b ON b.pos = f.pos
), q AS (
  SELECT *, CASE WHEN words > 0 THEN target / CAST(words AS DOUBLE) ELSE 1.0 END AS rate FROM r
), z AS (
  SELECT source, size, count(*) AS n, coalesce(sum(count(*)) OVER (PARTITION BY source ORDER BY size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM d GROUP BY source, size
), c AS (
  SELECT source, k, CAST('0x' || substr(draw, 4 * k + 1, 4) AS BIGINT) / CAST(65536.0 AS DOUBLE) AS u
  FROM q, range(0, 8) AS t(k)
), e AS (
  SELECT q.source, c.k, c.u, abs(sum(z.size * (floor((z.b + z.n) * q.rate + c.u) - floor(z.b * q.rate + c.u)))
         - first(q.target)) AS off
  FROM q JOIN z ON q.source IS NOT DISTINCT FROM z.source JOIN c ON c.source IS NOT DISTINCT FROM q.source
  GROUP BY q.source, c.k, c.u
), u AS (
  SELECT source, u FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY off, k) AS o FROM e) WHERE o = 1
), n AS (
  SELECT d.doc_id, d.size, q.words, q.target, q.rate, u.u,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.k) - 1 AS i
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source JOIN u ON u.source IS NOT DISTINCT FROM d.source
)
SELECT doc_id, size, words AS source_size, target,
       CAST((floor((i + 1) * rate + u) - floor(i * rate + u)) * size AS BIGINT) AS taken,
       CAST(floor((i + 1) * rate + u) - floor(i * rate + u) AS INTEGER) AS copies
FROM n
"""
