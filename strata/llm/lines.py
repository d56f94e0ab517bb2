"""Line dedup by a deletion-neighbourhood join (operator 6).

Lines are compared by their words (runs of anything but ASCII white space).  Of
equal lines the earliest stays; a line is also dropped when an earlier line, by
(document id, line number), is within an edit distance of one word (insert,
delete or substitute), for lines of at least ``MIN_WORDS`` words, so at a
likeness of 0.8 or more.

1. One pass hashes every line, and its leading and trailing halves, on the bytes of a
   slice; the hashes are written once.
2. Equal lines are pre-aggregated to their earliest occurrence, so a line with a
   third of all occurrences is one row from here on.
3. Two lines one edit apart share a leading or a trailing half exactly, so only
   lines that share a half with another go on: nothing is lost by this filter.
4. Those lines emit all variants with one word deleted, as hashed keys: with the
   deleted position (equal variants: one substitution) and without (equal to a
   whole line: one insertion).  Within a key the members are joined to the earliest only,
   never to each other.
5. The joined lines' words are compared, and what is one edit apart is dropped.

Defined results: null, empty and blank texts have no lines; blank lines are not
counted and always stay; rows of the same id and text count as one document;
lines of null ids come first; a line of any length is compared whole; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import _powers, byte_map, hash_spans, map_texts, mix64, utf8
from strata.session import materialize

MIN_WORDS = 5
SPACE = byte_map(lambda b: not (0x09 <= b <= 0x0D or b == 0x20), lower=False)
_Q = 0xD6E8FEB86659FD93
_Q_INV = pow(_Q, -1, 1 << 64)


class Lines:
    """Words of all lines of a slice and prefix sums of their hashes."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        on = SPACE[raw] != 0
        edge = np.zeros(len(raw) + 1, bool)
        edge[1:-1] = on[1:] != on[:-1]
        edge[offsets] = True
        cuts = np.flatnonzero(edge)
        begin, end = cuts[:-1], cuts[1:]
        good = on[begin] if len(begin) else np.empty(0, bool)
        begin, end = begin[good], end[good]
        self.h = hash_spans(raw, begin, end)
        breaks = np.cumsum(raw == 0x0A)               # line number within the slice
        at = breaks[begin] if len(begin) else begin
        row = np.searchsorted(offsets, begin, "right") - 1
        new = np.ones(len(begin), bool)
        new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
        self.first = np.flatnonzero(new)              # first word of each line
        self.last = np.append(self.first[1:], len(begin))
        self.row = row[self.first]
        base = np.concatenate([[0], breaks])[offsets[:-1]]
        self.number = at[self.first] - base[self.row]
        self.begin, self.end = begin, end
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(begin) + 1, np.uint64)
            np.cumsum(self.h * _powers(_Q, len(begin)), out=self.sums[1:])
        self.inverse = _powers(_Q_INV, len(begin) + 2)

    def span(self, a: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Polynomial of the words a to z (exclusive), as if they opened a line."""
        with np.errstate(over="ignore"):
            return (self.sums[z] - self.sums[a]) * self.inverse[a]

    @staticmethod
    def seal(poly: np.ndarray, n: np.ndarray, salt: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64(poly + n.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.uint64(salt))

    def whole(self) -> np.ndarray:
        return self.seal(self.span(self.first, self.last), self.last - self.first, 1)

    def halves(self) -> list[np.ndarray]:
        """Leading and trailing halves of h words for h = n // 2 and (n - 1) // 2."""
        n = self.last - self.first
        out = []
        for h in (n // 2, (n - 1) // 2):
            out.append(self.seal(self.span(self.first, self.first + h), h, 2))
            out.append(self.seal(self.span(self.last - h, self.last), h, 3))
        return out

    def variants(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Line, deleted word, key with and key without the position."""
        n = self.last - self.first
        line = np.repeat(np.arange(len(n)), n)
        word = np.arange(len(self.h))
        i = word - self.first[line]
        with np.errstate(over="ignore"):
            rest = self.span(self.first[line], word) \
                + self.span(word + 1, self.last[line]) * _powers(_Q, int(n.max(initial=0)) + 1)[i]
            bare = self.seal(rest, n[line] - 1, 1)     # comparable with whole lines
            return line, i, self.seal(rest, n[line] * 4096 + i, 4), bare


def hashed_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace the text by one row per line that has words: ``line_no, n, h, halves``."""
    def run(col: pa.Array) -> dict:
        s = Lines(*utf8(col))
        h, halves = s.whole().view(np.int64), np.stack(s.halves(), 1).view(np.int64)
        n, cut = s.last - s.first, np.searchsorted(s.row, np.arange(len(col) + 1))
        rows = pa.StructArray.from_arrays(
            [pa.array(s.number.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(h),
             pa.ListArray.from_arrays(np.arange(len(h) + 1, dtype=np.int32) * 4, halves.ravel())],
            ["line_no", "n", "h", "halves"])
        return {"lines": pa.ListArray.from_arrays(cut.astype(np.int32), rows)}

    kind = "array<struct<line_no: int, n: int, h: long, halves: array<long>>>"
    found = map_texts(docs, {"lines": kind}, run, text_col)
    return found.select(*(c for c in found.columns if c != "lines"), F.inline("lines"))


def _variant_rows(lines: DataFrame) -> DataFrame:
    """``h, doc, same, line_no, key, sub`` of all one-word deletions of ``lines``
    (``sub``: the key has the position; else it equals a whole line's hash)."""
    def run(col: pa.Array) -> dict:
        s = Lines(*utf8(col))
        line, _, sub, bare = s.variants()
        n = s.last - s.first
        out = [[] for _ in range(len(col))]
        cut = np.searchsorted(line, np.arange(len(n) + 1))
        for k, r in enumerate(s.row):
            a, z = cut[k], cut[k + 1]
            out[r] = [{"key": x, "sub": True} for x in sub[a:z].view(np.int64).tolist()]
            if n[k] > MIN_WORDS:
                out[r] += [{"key": x, "sub": False} for x in np.unique(bare[a:z]).view(np.int64).tolist()]
        return {"v": out}

    found = map_texts(lines, {"v": "array<struct<key: long, sub: boolean>>"}, run, "line")
    return found.select("h", "doc", "same", "line_no", F.inline("v"))


def one_edit(a: str, b: str) -> Column:
    """Whether two word arrays are within an insertion, deletion or substitution."""
    return F.expr(f"""abs(size({a}) - size({b})) <= 1 AND size({a}) + size({b}) > 0 AND
      aggregate(sequence(1, greatest(size({a}), size({b}))), 0, (s, i) ->
        CASE WHEN s = i - 1 AND get({a}, i - 1) <=> get({b}, i - 1) THEN i ELSE s END)
      + aggregate(sequence(1, greatest(size({a}), size({b}))), 0, (s, i) ->
        CASE WHEN s = i - 1 AND get({a}, size({a}) - i) <=> get({b}, size({b}) - i) THEN i ELSE s END)
      >= greatest(size({a}), size({b})) - 1""")


def _order(prefix: str = "") -> Column:
    return F.struct(*(F.col(prefix + c) for c in ("doc", "same", "line_no")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document (``doc, same``: id and hash of the text): ``n_lines, n_copies,
    n_near, kept`` (numbers of the lines that stay, blank ones aside)."""
    texts = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("same"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = materialize(hashed_lines(texts), "lines")
    first = lines.groupBy("h").agg(F.min(_order()).alias("o"), F.max("n").alias("n"),
                                   F.first("halves").alias("halves"))
    first = materialize(first.select("h", "o.*", "n", "halves"), "distinct-lines")
    # 3. Lines that share a half with another line.
    half = first.where(F.col("n") >= MIN_WORDS).select("h", F.explode(F.array_distinct("halves")).alias("k"))
    shared = half.groupBy("k").agg(F.count("*").alias("c")).where("c > 1").select("k")
    wanted = half.join(shared, "k", "left_semi").select("h").distinct()
    near = near_lines(texts, first.join(wanted, "h", "left_semi").select("h", "doc", "same", "line_no"))
    kept = (first.join(near, "h", "left").select("doc", "same", "line_no", F.col("gone").isNotNull().alias("gone"))
            .groupBy("doc", "same").agg(
                F.sum(F.col("gone").cast("long")).alias("n_near"),
                F.sort_array(F.collect_list(F.when(~F.col("gone"), F.col("line_no")))).alias("kept"),
                F.count("*").alias("n_first")))
    per_doc = lines.groupBy("doc", "same", "line_no").agg(F.first("h").alias("h")) \
        .groupBy("doc", "same").agg(F.count("*").alias("n_lines"))
    zero = F.lit(0).cast("long")
    return (texts.select("doc", "same").distinct()
            .join(per_doc.withColumnsRenamed({"doc": "_d1", "same": "_s1"}),
                  F.col("doc").eqNullSafe(F.col("_d1")) & F.col("same").eqNullSafe(F.col("_s1")), "left")
            .join(kept.withColumnsRenamed({"doc": "_d2", "same": "_s2"}),
                  F.col("doc").eqNullSafe(F.col("_d2")) & F.col("same").eqNullSafe(F.col("_s2")), "left")
            .select("doc", "same", F.coalesce("n_lines", zero).alias("n_lines"),
                    (F.coalesce("n_lines", zero) - F.coalesce("n_first", zero)).alias("n_copies"),
                    F.coalesce("n_near", zero).alias("n_near"),
                    F.coalesce("kept", F.array().cast("array<int>")).alias("kept")))


def near_lines(texts: DataFrame, some: DataFrame) -> DataFrame:
    """``h, gone``: those of some distinct lines (``h`` and their earliest place) that are
    one edit from an earlier one of them."""
    asked = some.groupBy("doc", "same").agg(F.collect_list(F.struct("line_no", "h")).alias("asked"))
    pick = (texts.join(asked.withColumnsRenamed({"doc": "_d", "same": "_s"}),
                       F.col("doc").eqNullSafe(F.col("_d")) & F.col("same").eqNullSafe(F.col("_s")))
            .groupBy("doc", "same").agg(F.min("text").alias("text"), F.first("asked").alias("asked"))
            .withColumn("text", F.split("text", "\n"))
            .select("doc", "same", "text", F.inline("asked"))
            .select("h", "doc", "same", "line_no", F.get("text", F.col("line_no")).alias("line")))
    pick = materialize(pick, "candidate-lines")
    v = _variant_rows(pick)
    # 4. Members of a key are joined to the earliest of the key.
    subs = v.where("sub")
    low = subs.groupBy("key").agg(F.min(F.struct(_order().alias("o"), "h")).alias("m"), F.count("*").alias("c")) \
        .where("c > 1").select("key", F.col("m.h").alias("other"))
    by_sub = subs.join(low, "key").select("h", "other").where("h <> other")
    whole = pick.select(F.col("h").alias("key"), _order().alias("wo"))
    bare = v.where("not sub").select("h", _order().alias("o"), "key").join(whole, "key")
    after = bare.where("o > wo").select("h", F.col("key").alias("other"))
    before = bare.where("o < wo").groupBy("key").agg(F.min(F.struct("o", "h")).alias("m")) \
        .select(F.col("key").alias("h"), F.col("m.h").alias("other"))
    pairs = by_sub.unionByName(after).unionByName(before).distinct()
    # 5. The words themselves.
    words = pick.select("h", F.filter(F.split("line", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("w"))
    return (pairs.join(words, "h").join(words.select(F.col("h").alias("other"), F.col("w").alias("w2")), "other")
            .where(one_edit("w", "w2")).select("h").distinct().withColumn("gone", F.lit(True)))


#: DuckDB: the same over the documents table.
ORACLE = r"""
WITH t AS (
  SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents
), l AS (
  SELECT doc_id, i - 1 AS line_no,
         list_filter(regexp_split_to_array(x[i], '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM t), unnest(range(1, len(x) + 1)) AS u(i)
), c AS (SELECT * FROM l WHERE len(w) > 0
), f AS (
  SELECT w, min((doc_id, line_no)) AS o FROM c GROUP BY w
), v AS (
  SELECT w, o, i, list_concat(w[1 : i - 1], w[i + 1 :]) AS k
  FROM f, unnest(range(1, len(w) + 1)) AS u(i) WHERE len(w) >= 5
), g AS (
  SELECT DISTINCT v.w FROM v JOIN (SELECT k, i, min(o) AS o FROM v GROUP BY k, i) m
    ON v.k = m.k AND v.i = m.i AND m.o < v.o
  UNION SELECT v.w FROM v JOIN f ON v.k = f.w AND len(f.w) >= 5 AND f.o < v.o
  UNION SELECT f.w FROM v JOIN f ON v.k = f.w AND len(f.w) >= 5 AND v.o < f.o
), s AS (
  SELECT f.o[1] AS doc_id, f.o[2] AS line_no, g.w IS NOT NULL AS gone FROM f LEFT JOIN g ON f.w = g.w
), k AS (
  SELECT doc_id, count(*) AS n_first, count(*) FILTER (WHERE gone) AS n_near,
         string_agg(CASE WHEN NOT gone THEN CAST(line_no AS VARCHAR) END, ',' ORDER BY line_no) AS kept
  FROM s GROUP BY doc_id
), n AS (SELECT doc_id, count(*) AS n_lines FROM c GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_lines, 0) - coalesce(n_first, 0) AS n_copies,
       coalesce(n_near, 0) AS n_near, coalesce(kept, '') AS kept
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""
