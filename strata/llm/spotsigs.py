"""SpotSigs document fingerprints (operator 1), DataFrame functions only.

A signature is a common word (the anchor) with the ``CHAIN`` content words that
follow it, other common words skipped.  In a stretch of more than ``STRETCH``
content words, each of them is an anchor (junk, tables and names have few common
words).  The fingerprint of a text is the set of
its signatures; two texts are compared by the Jaccard likeness of their sets.
Because a likeness of t needs sizes within a factor t, ``search`` deals the sets
into partitions by length, compares only within a partition and the next, looks
candidates up by the rarest signatures of each set alone, and checks the sizes
before any set is intersected.

``with_next`` puts beside every document the next one in descending id order without
a global window: ids alone are range-partitioned to find bucket bounds, each row goes to the
bucket of its id, and the first row of a bucket is also sent to the bucket
before it (the first of all to the last), so each text is shuffled once.

Defined results: null texts count as empty; an empty text has the empty
fingerprint, and two empty ones have likeness 1; a short text without
common words takes every word as an anchor, one without words takes itself as the signature,
so no other text has the empty fingerprint; equal texts have equal fingerprints; rows of one id stand
in the order of their texts' hashes, rows without id last and in one bucket; an
empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Common words of English, French, German and Spanish.
ANCHORS = """
a an and are as at be by for from have in is it not of on or that the this to was were with
au aux avec ce dans de des du en est et il la le les ne par pas pour que qui se sur un une
als auf aus das dem den der des die ein eine einen für ich im ist mit nicht sich sie und von zu
como con del el es ha las lo los más no para por se su sus una y
""".split()
CHAIN, STRETCH = 2, 7
ROWS_PER_BUCKET, MAX_BUCKETS, COARSE = 1_000, 1 << 14, 128


#: A run of anchors (marked, maybe none) and the content word behind it.
RUN = "((?: \u0001[^ ]+)*+) ([^\u0001 ]++)"


def _hash32(x: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(x), 32)


def with_signatures(df: DataFrame, text_col: str, name: str, chain: int = CHAIN) -> DataFrame:
    """``df`` plus ``name``: the sorted distinct signatures (32-bit hashes as longs)."""
    words, marked, sets = f"{name}__w", f"{name}__m", f"{name}__s"
    anchors = "|".join(sorted(set(ANCHORS)))
    # Content words and the anchors before each: every anchor of a run goes with the words
    # behind the run, which are looked up once, however long it is.
    # A mark behind the last word ends the last run, so that no match is tried in vain.
    runs_of, content = f"{name}__r", f"{name}__c"
    closed = F.concat(F.col(marked), F.lit("\u0002"))
    every = lambda g: F.regexp_extract_all(closed, F.lit(RUN), F.lit(g))
    behind = [F.slice(F.col(content), k + 1, F.greatest(F.size(content), F.lit(1))).alias(f"c{k}") for k in range(chain)]
    rows = F.arrays_zip(F.col(runs_of).alias("run"), *behind)
    chains = F.flatten(F.transform(rows, lambda x: F.when(x.run == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(F.array_distinct(F.split(F.ltrim(x.run), " ")), lambda a: _hash32(F.concat_ws(
            " ", F.substr(a, F.lit(2)), *(x[f"c{k}"] for k in range(chain))))))))
    bare = "(?: [^\u0001 ]++)"
    spread = F.regexp_extract_all(F.col(marked), F.lit(
        f"(?<= )(?=([^\u0001 ]++{bare}{{{chain}}}){bare}{{{STRETCH - chain}}})"), F.lit(1))
    runs = F.regexp_extract_all(F.col(words), F.lit(f"(?<= )(?=([^ ]+(?: [^ ]+){{0,{chain}}}))"), F.lit(1))
    own = F.when(F.length(F.trim(F.col(words))) > 0, F.transform(runs, _hash32)) \
        .when(F.length(text_col) > 0, F.array(_hash32(F.col(text_col)))) \
        .otherwise(F.array().cast("array<bigint>"))
    return (df.withColumn(words, F.concat(F.lit(" "), F.regexp_replace(
                F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}\p{N}]+", " "), F.lit(" ")))
            .withColumn(words, F.regexp_replace(words, "  +", " "))
            .withColumn(marked, F.regexp_replace(words, f"(?<= )({anchors})(?= )", "\u0001$1"))
            .withColumns({c: F.slice(every(g), 1, F.greatest(F.size(every(g)) - 1, F.lit(0)))
                          for g, c in ((1, runs_of), (2, content))})
            .withColumn(sets, F.concat(chains, F.transform(spread, _hash32)))
            .withColumn(name, F.array_sort(F.array_distinct(
                F.when(F.size(sets) > 0, F.col(sets)).otherwise(own))))
            .drop(words, marked, sets, runs_of, content))


def as_text(signatures: str) -> Column:
    """The fingerprint as a string: its signatures in hex, point-joined."""
    return F.lower(F.array_join(F.transform(signatures, F.hex), "."))


def likeness(a: str, b: str) -> Column:
    """Jaccard likeness of two fingerprints (both empty: 1)."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(both / either)


# ------------------------------------------------------- next document by id
def _bounds(docs: DataFrame, id_col: str) -> list[int]:
    """Largest ids of about equal id ranges, descending (at most ``MAX_BUCKETS``)."""
    ids = docs.select(F.col(id_col).alias("i")).where("i is not null")
    n = min(MAX_BUCKETS, -(-ids.count() // ROWS_PER_BUCKET))
    if not n:
        return []
    tops = (ids.repartitionByRange(n, "i").groupBy(F.spark_partition_id().alias("p"))
            .agg(F.max("i").alias("top")).collect())
    return sorted({r["top"] for r in tops}, reverse=True)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
              ) -> tuple[DataFrame, Window]:
    """``_id, _text, _next`` (text of the next row, descending ids, the last
    row's next is the first), ``_copy`` for the copies that only stand as
    a bucket's end, and the window over which more can be taken from the next row."""
    bounds = _bounds(docs, id_col)
    df = docs.select(F.col(id_col).cast("long").alias("_id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("_text")) \
        .withColumn("_tie", F.xxhash64("_text"))
    first_null = df.where("_id is null").agg(F.min("_tie")).first()[0]
    last = len(bounds) - (first_null is None)
    tops = F.array(*(F.lit(b).cast("long") for b in bounds)).cast("array<bigint>")
    coarse = F.array(*(F.lit(b).cast("long") for b in bounds[::COARSE])).cast("array<bigint>")
    above = F.size(F.filter(coarse, lambda b: b >= F.col("_id"))) - 1
    bucket = F.when(F.col("_id").isNull(), F.lit(len(bounds))).otherwise(
        above * COARSE + F.size(F.filter(F.slice(tops, above * COARSE + 1, F.lit(COARSE)),
                                         lambda b: b >= F.col("_id"))) - 1)
    df = df.withColumn("_b", bucket)
    place = lambda b, turn, copy: F.struct(
        b.cast("int").alias("b"), F.lit(turn).alias("turn"), F.lit(copy).alias("copy"))
    opens = F.coalesce(F.get(tops, F.col("_b")) == F.col("_id"), F.lit(False))
    if first_null is not None:
        opens = opens | (F.col("_id").isNull() & (F.col("_tie") == first_null))
    places = F.array_compact(F.array(
        place(F.col("_b"), 0, False),
        F.when(opens & (F.col("_b") > 0), place(F.col("_b") - 1, 0, True)),
        F.when(opens & (F.col("_b") == 0), place(F.lit(last), 1, True))))
    dealt = df.select("_id", "_text", "_tie", F.explode(places).alias("_p")).select(
        "_id", "_text", "_tie", F.col("_p.b").alias("_b"), F.col("_p.turn").alias("_turn"),
        F.col("_p.copy").alias("_copy"))
    w = Window.partitionBy("_b").orderBy("_turn", F.col("_id").desc_nulls_last(), "_tie")
    return dealt.withColumn("_next", F.lead("_text").over(w)), w


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit, whose last third comes from
    the next text: ``doc_id, n_chars, edited_sha256, signatures, edited_signatures, near_edited, near_next``."""
    dealt, w = with_next(docs, id_col, text_col)
    n = F.char_length("_text")
    third = (F.col("_n") / 3).cast("int")
    df = dealt.withColumn("_n", n).withColumn("_edited", F.concat(
        F.substring("_text", F.lit(1), F.col("_n") - third),
        F.substring("_next", F.lit(1), third)))
    df = with_signatures(df, "_text", "signatures")
    df = df.withColumn("_next_sigs", F.lead("signatures").over(w)).where("not _copy")
    df = with_signatures(df, "_edited", "edited_signatures")
    return df.select(F.col("_id").alias(id_col), F.col("_n").cast("long").alias("n_chars"),
                     F.sha2("_edited", 256).alias("edited_sha256"), "signatures", "edited_signatures",
                     likeness("signatures", "edited_signatures").alias("near_edited"),
                     likeness("signatures", "_next_sigs").alias("near_next"))


# ----------------------------------------------------------------- search
def search(signatures: DataFrame, queries: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``query, id, likeness`` of all rows (``id, signatures``) whose set is at least
    ``threshold`` like a query's (``query, signatures``).

    Sets are dealt into length partitions whose bounds grow by 1 / threshold; a
    query looks into its own partition and both neighbours.  Of a set of n signatures only the
    n - ceil(t n) + 1 rarest are looked up: two sets that share none of these
    cannot reach t.  Sizes are compared before the sets are.
    """
    step = float(-math.log(threshold))
    part = F.floor(F.log(F.greatest(F.size("signatures"), F.lit(1))) / step).cast("int")
    counts = signatures.select(F.explode("signatures").alias("s")).groupBy("s").agg(F.count("*").alias("n"))

    def rare(df: DataFrame, key: str) -> DataFrame:
        keyed = df.withColumn("_u", F.monotonically_increasing_id()).withColumn("_part", part)
        rows = keyed.select("_u", key, "_part", F.size("signatures").alias("_n"), F.explode("signatures").alias("s"))
        ranked = rows.join(counts, "s", "left").groupBy("_u", key, "_part", "_n").agg(
            F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "s"))).alias("_o"))
        keep = (F.col("_n") - F.ceil(F.lit(threshold) * F.col("_n") - 1e-9) + 1).cast("int")
        return ranked.select(key, "_part", F.array_sort(F.transform("_o", lambda x: x.s)).alias("_set"),
                             F.explode(F.transform(F.slice("_o", F.lit(1), keep), lambda x: x.s)).alias("s"))

    left = rare(queries, "query").withColumn("_part", F.explode(F.array(*(F.col("_part") + k for k in (-1, 0, 1)))))
    right = rare(signatures, "id").select("id", "_part", "s", F.col("_set").alias("_other"))
    sizes = F.least(F.size("_set"), F.size("_other")) >= F.lit(threshold) * F.greatest(F.size("_set"), F.size("_other"))
    near = left.join(right, ["_part", "s"]).where(sizes).select("query", "id", "_set", "_other").distinct()
    return (near.withColumn("likeness", likeness("_set", "_other")).where(F.col("likeness") >= threshold)
            .select("query", "id", "likeness"))
