"""Benchmark decontamination with a positional inverted index (operator 8).

``write_index`` stores the postings of every training word: the documents are cut
into blocks of a few MB, and a block holds its distinct words (64-bit hashes,
sorted), and for each word the ascending positions in the block.  The index is
partitioned by document, so building it shuffles nothing, a document with any
share of the words stays within its own block, and a lost executor costs the
blocks it was writing.

``find`` looks benchmark windows up: in each block a window is dropped
at once if one of its words has no postings; else its lists are intersected from
the rarest word on, each shifted by the word's offset in the window.  With
``slack`` 0 the result is exact phrases; with a larger one (proximity matches) a match
starts at the window's first word, and every other word stands in the same document at
most that many words from its place behind it, wherever blocks are cut.

The benchmark is checked for size before it is broadcast: repeated rows count once, it is
cut into parts of about ``PART_BYTES`` of text and the index is read once per part, so any number
of items is exact.

Defined results: null and empty texts have no words and are never hit; an item
without words has no window; items of fewer than 13 words are one window; an
item with a null id counts for hits but not in the item list; repeated rows are
separate; empty documents give no rows, an empty benchmark no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.llm.common import ALNUM, slices, utf8, words_of

WINDOW = 13
#: Text bytes of one index block (more if one document is longer).
BLOCK_BYTES = 4 << 20
#: Benchmark text that one pass over the index looks up, at most.
PART_BYTES = 2 << 20


# ------------------------------------------------------------------ index
def write_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Postings of all words of all documents, as Parquet blocks under ``path``."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T._parse_datatype_string(
        f"part int, block int, doc_ids array<{dict(df.dtypes)['doc_id']}>, first binary, "
        "terms binary, ends binary, posts binary")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, block = TaskContext.get().partitionId(), 0
        for batch in batches:
            for b in slices(batch, "text", BLOCK_BYTES):
                raw, offsets = utf8(b.column(1))
                h, _, _, row = words_of(raw, offsets, ALNUM)
                terms, code = np.unique(h, return_inverse=True)
                posts = np.argsort(code, kind="stable").astype("<i4")
                ends = np.cumsum(np.bincount(code, minlength=len(terms))).astype("<i4")
                first = np.searchsorted(row, np.arange(b.num_rows + 1)).astype("<i4")
                yield pa.RecordBatch.from_pydict(
                    {"part": [part], "block": [block], "doc_ids": [b.column(0).to_pylist()],
                     "first": [first.tobytes()], "terms": [terms.astype("<u8").tobytes()],
                     "ends": [ends.tobytes()], "posts": [posts.tobytes()]}, schema=arrow)
                block += 1

    df.mapInArrow(run, schema).write.parquet(path)


class Block:
    """One block of the index."""

    def __init__(self, first: bytes, terms: bytes, ends: bytes, posts: bytes):
        self.first = np.frombuffer(first, "<i4").astype(np.int64)
        self.terms = np.frombuffer(terms, "<u8")
        self.ends = np.concatenate([[0], np.frombuffer(ends, "<i4").astype(np.int64)])
        self.posts = np.frombuffer(posts, "<i4")

    def near(self, have: list[np.ndarray], slack: int, rarest: list[int]) -> np.ndarray:
        """Places of a window's first word of which each word j stands at most ``slack``
        words from its place j behind it, in the same document.  ``have``: postings of its words."""
        j, first = rarest[0], have[0].astype(np.int64)
        x = have[j].astype(np.int64)
        a, z = np.searchsorted(first, x - j - slack), np.searchsorted(first, x - j + slack, "right")
        n = z - a                                     # first words that the rarest word allows
        p = np.unique(first[np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)])
        for j in rarest:
            doc = np.searchsorted(self.first, p, "right") - 1
            low, high = np.maximum(p + j - slack, self.first[doc]), np.minimum(p + j + slack, self.first[doc + 1] - 1)
            at = np.searchsorted(have[j], low)
            inside = at < len(have[j])
            p, at, high = p[inside], at[inside], high[inside]
            p = p[have[j][at] <= high]
        return p

    def find(self, q: "Windows", slack: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Window and start (word of the block) of every match."""
        if not len(self.terms) or not len(q.lengths):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        spot = np.minimum(np.searchsorted(self.terms, q.terms), len(self.terms) - 1)
        there = self.terms[spot] == q.terms
        count = np.where(there, self.ends[spot + 1] - self.ends[spot], 0)
        need = np.where(q.codes >= 0, count[q.codes], np.iinfo(np.int64).max)
        live = np.flatnonzero((need > 0).all(1))
        rarest = np.argsort(need[live], axis=1, kind="stable")
        hit_w, hit_s = [], []
        for w, order in zip(live, rarest):
            n, codes, start = q.lengths[w], q.codes[w], None
            if slack:
                lists = [self.posts[self.ends[spot[c]]:self.ends[spot[c] + 1]] for c in codes[:n]]
                found = self.near(lists, slack, order[:n].tolist())
                hit_s.append(found)
                hit_w.append(np.full(len(found), w))
                continue
            for j in order[:n]:
                t = spot[codes[j]]
                have = self.posts[self.ends[t]:self.ends[t + 1]]
                if start is None:
                    start = have.astype(np.int64) - j
                    continue
                at = np.searchsorted(have, start + j)
                inside = at < len(have)
                start, at = start[inside], at[inside]
                start = start[have[at] == start + j]
                if not len(start):
                    break
            doc = np.searchsorted(self.first, np.maximum(start, 0), "right")
            ok = (start >= 0) & (start + n <= self.first[np.minimum(doc, len(self.first) - 1)])
            hit_s.append(start[ok])
            hit_w.append(np.full(ok.sum(), w))
        if not hit_w:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(hit_w), np.concatenate(hit_s)


class Windows:
    """Distinct windows of some items: word codes (-1 beyond a short one), the
    items of each."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        raw, offsets = utf8(pa.array([t or "" for _, t in items], pa.large_string()))
        h, _, _, row = words_of(raw, offsets, ALNUM)
        self.terms, code = np.unique(h, return_inverse=True)
        seen: dict[tuple, set] = {}
        at = np.searchsorted(row, np.arange(len(items) + 1))
        for (item, _), a, b in zip(items, at, at[1:]):
            words = code[a:b].tolist()
            for i in range(max(1, len(words) - window + 1) if words else 0):
                seen.setdefault(tuple(words[i:i + window]), set()).add(item)
        self.items = [sorted(x for x in v if x is not None) for v in seen.values()]
        self.lengths = np.array([len(k) for k in seen], np.int64)
        self.codes = np.full((len(seen), window), -1, np.int32)
        for i, k in enumerate(seen):
            self.codes[i, :len(k)] = k


def _parts(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list]:
    """The items, in lists of at most about ``PART_BYTES`` of text."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = -(-int(total) // PART_BYTES) or 1
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(r["item"], r["text"]) for r in part.collect()]


# ------------------------------------------------------------------ lookup
def matches(spark: SparkSession, path: str, benchmark: DataFrame, item_col: str = "item_id",
            text_col: str = "text", window: int = WINDOW, slack: int = 0) -> DataFrame:
    """Every match: ``doc_id, item, start, length`` (words of the document)."""
    out = None
    for items in _parts(benchmark, item_col, text_col):
        df = spark.read.parquet(path)
        kind = dict(df.dtypes)["doc_ids"][len("array<"):-1]
        schema = T._parse_datatype_string(f"doc_id {kind}, item string, start long, length long")
        shared = spark.sparkContext.broadcast(Windows(items, window))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, arrow=to_arrow_schema(schema)):
            for batch in batches:
                for ids, *cols in zip(*(batch.column(c) for c in range(5))):
                    b, q = Block(*(c.as_py() for c in cols)), shared.value
                    w, start = b.find(q, slack)
                    doc = np.searchsorted(b.first, start, "right") - 1
                    found = [(ids[int(d)].as_py(), item, int(s - b.first[d]), int(q.lengths[i]))
                             for i, s, d in zip(w, start, doc) for item in q.items[i]]
                    cols_out = list(zip(*found)) or [[], [], [], []]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(cols_out, arrow)], schema=arrow)

        got = df.select("doc_ids", "first", "terms", "ends", "posts").mapInArrow(run, schema)
        out = got if out is None else out.unionByName(got)
    return out


_HITS = "part int, block int, at int, n_words long, spans array<struct<a: long, b: long>>, items array<string>"


def _hit_rows(df: DataFrame, shared, kind: str) -> DataFrame:
    """One row per document: words, merged hit spans and items of one benchmark part."""
    schema = T._parse_datatype_string(f"doc_id {kind}, {_HITS}")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, block, ids, *cols = (batch.column(c)[i].as_py() for c in range(7))
                b, q = Block(*cols), shared.value
                w, start = b.find(q)
                n = len(ids)
                spans: list[list] = [[] for _ in range(n)]
                items: list[set] = [set() for _ in range(n)]
                order = np.argsort(start, kind="stable")
                doc = np.searchsorted(b.first, start, "right") - 1
                for k in order:
                    d = int(doc[k])
                    a = int(start[k] - b.first[d])
                    z, own = a + int(q.lengths[w[k]]), spans[d]
                    if own and a <= own[-1]["b"]:
                        own[-1]["b"] = max(z, own[-1]["b"])
                    else:
                        own.append({"a": a, "b": z})
                    items[d].update(q.items[w[k]])
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": ids, "part": [part] * n, "block": [block] * n, "at": list(range(n)),
                     "n_words": np.diff(b.first), "spans": spans, "items": [sorted(x) for x in items]},
                    schema=arrow)

    return df.select("part", "block", "doc_ids", "first", "terms", "ends", "posts").mapInArrow(run, schema)


def _covered(spans: str) -> Column:
    """Words under spans that may overlap (SQL over the sorted array)."""
    return F.expr(f"""aggregate(array_sort({spans}), struct(0L AS n, 0L AS upto),
        (s, x) -> struct(s.n + greatest(x.b - greatest(x.a, s.upto), 0L) AS n,
                         greatest(s.upto, x.b) AS upto), s -> s.n)""")


def contamination(spark: SparkSession, path: str, benchmark: DataFrame, item_col: str = "item_id",
                  text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per indexed document: ``doc_id, part, block, at, n_words, n_hit, items``."""
    df = spark.read.parquet(path)
    kind = dict(df.dtypes)["doc_ids"][len("array<"):-1]
    found = [_hit_rows(df, spark.sparkContext.broadcast(Windows(items, window)), kind)
             for items in _parts(benchmark, item_col, text_col)]
    out = found[0]
    if len(found) > 1:
        for more in found[1:]:
            out = out.unionByName(more)
        out = out.groupBy("part", "block", "at").agg(
            F.min("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return out.select("doc_id", "part", "block", "at", "n_words", _covered("spans").alias("n_hit"),
                      F.array_sort("items").alias("items"))


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """At least one word hit, and at least a twentieth of the words."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


#: DuckDB: the same by joining the texts of windows.
ORACLE = r"""
WITH lo AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l
), d AS (
  SELECT doc_id, row_number() OVER () AS r,
         coalesce(regexp_extract_all(translate(text, u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents, lo
), b AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark, lo
), bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
         array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS k
  FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0
), dw AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS k
  FROM d, (SELECT DISTINCT n FROM bw) AS s, unnest(range(1, len(w) - n + 2)) AS t(i)
), m AS (SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n
), h AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r
), it AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM m WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN it USING (r)
"""
