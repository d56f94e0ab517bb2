"""Substring dedup by prefix-partitioned suffix trees (operator 12).

A window is ``WINDOW`` consecutive words (runs of anything but ASCII white space)
of one document.  A word goes when a window that covers it also starts in a
document with a smaller id; windows are judged on the input.

1. Documents are packed into slices of about ``SLICE`` bytes, written once
   (compressed): the unit that every later step works on and answers to.
2. Anchors: of the ``GRAM``-word grams of a window the one with the least hash.
   Equal windows have equal anchors, so a window whose anchor stands in one
   document only is no repeat and goes no further.  About every third word is an
   anchor; a slice sends each distinct one once, as four bytes.
3. The suffixes that are left are split by variable-length prefixes: the shortest
   one whose words are together rare enough (information by counts of all words,
   ``BINS`` counters) that its suffixes fit a share of one task's memory, or
   the whole window.  Suffixes with an equal window have an equal prefix, so each
   repeat lies within one group.
4. A group builds the suffix tree of its suffixes, as sorted suffixes and the
   lengths of their common prefixes (LCP), down to ``WINDOW`` words.  Its
   internal nodes at that depth are the repeats; each names its smallest document.
   A slice sends an equal suffix once with its smallest document, so a passage
   that a third of all documents share costs a group one entry a slice.
5. Slices take the answers, join consecutive windows to maximal spans and cut them.

Words are compared by 64-bit hashes: a window by one over its words and by 8 bits of
each word (which order the tree).  Defined results: null, empty and blank texts have no words; a null id is
neither smaller nor larger than any, so such a row keeps all words and takes
none from others; rows of one id take nothing from each other; repeated rows give
a row each; a text of any length is read whole; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import _P, _P_INV, _powers, byte_map, hash_spans, mix64, utf8
from strata.session import materialize

WINDOW = 13
GRAM = 8
#: Bytes of text in a slice (unless one document is longer).
SLICE = 2 << 20
#: Counters of words by hash.
BINS = 1024
#: Suffixes that one group is meant to hold, and the least number of groups.
GROUP = 1 << 20
MIN_GROUPS = 512
#: Units of information in a bit.
UNIT = 1024
SPACE = byte_map(lambda b: not (0x09 <= b <= 0x0D or b == 0x20), lower=False)


class Words:
    """Words of the documents of a slice: hash, bytes, document."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        on = SPACE[raw] != 0
        on |= raw == 0                                    # a NUL is no white space
        edge = np.zeros(len(raw) + 1, bool)
        edge[1:-1] = on[1:] != on[:-1]
        edge[offsets] = True
        cuts = np.flatnonzero(edge)
        begin, end = cuts[:-1], cuts[1:]
        good = on[begin] if len(begin) else np.empty(0, bool)
        self.raw, self.begin, self.end = raw, begin[good], end[good]
        self.h = hash_spans(raw, self.begin, self.end)
        self.doc = np.searchsorted(offsets, self.begin, "right") - 1
        self._sums = np.zeros(len(self.h) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(self.h * _powers(_P, len(self.h)), out=self._sums[1:])

    def span(self, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Hash of the ``n`` words from each position."""
        with np.errstate(over="ignore"):
            poly = (self._sums[at + n] - self._sums[at]) * _powers(_P_INV, len(self.h) + 1)[at]
            return mix64(poly + np.asarray(n).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """First words of the windows."""
        last = len(self.h) - size + 1
        at = np.arange(max(last, 0))
        return at[self.doc[at] == self.doc[at + size - 1]]

    def anchors(self, at: np.ndarray, size: int) -> np.ndarray:
        """Per window the hash of its anchor."""
        gram = min(GRAM, size)
        if not len(at):
            return np.empty(0, np.uint64)
        g = self.span(np.arange(len(self.h) - gram + 1), gram)
        around = np.lib.stride_tricks.sliding_window_view(g, size - gram + 1)
        return around[at].min(1)


def least(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the place of a first one, their least and greatest document."""
    if not len(keys):
        return keys, np.empty(0, np.int64), docs, docs
    order = np.argsort(keys, kind="stable")
    k, d = keys[order], docs[order]
    start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    return k[start], order[start], np.minimum.reduceat(d, start), np.maximum.reduceat(d, start)


def pack(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Slices: ``slice, ids, sizes, body`` and the counts of words by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, codec = TaskContext.get().partitionId(), pa.Codec("zstd", 3)
        ids, sizes, parts, held, made = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            raw = np.concatenate([np.empty(0, np.uint8), *parts])
            w = Words(raw, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
            bins = np.bincount((w.h % np.uint64(BINS)).astype(np.int64), minlength=BINS)
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + made], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([codec.compress(raw.tobytes(), asbytes=True)], pa.binary()),
                 pa.array([len(raw)], pa.int64()), pa.array([len(w.h)], pa.int64()), pa.array([bins], pa.list_(pa.int64()))],
                ["slice", "ids", "sizes", "body", "n_bytes", "n_words", "bins"])

        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            for r, i in enumerate(batch.column(0).to_pylist()):
                ids.append(i)
                sizes.append(int(offsets[r + 1] - offsets[r]))
                parts.append(raw[offsets[r]:offsets[r + 1]])
                held += sizes[-1]
                if held >= SLICE or len(ids) >= 100_000:
                    yield flush()
                    ids, sizes, parts, held, made = [], [], [], 0, made + 1
        if ids:
            yield flush()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        run, "slice long, ids array<long>, sizes array<long>, body binary, n_bytes long, n_words long, bins array<long>")


class Slice:
    """A slice read back; documents without id take no part in windows."""

    def __init__(self, t: pa.Table | pa.RecordBatch):
        row = {n: t.column(n)[0].as_py() for n in ("slice", "ids", "sizes", "body", "n_bytes")}
        self.id, self.ids, self.sizes = row["slice"], row["ids"], row["sizes"]
        raw = np.frombuffer(pa.Codec("zstd").decompress(row["body"], row["n_bytes"], asbytes=True), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.words = Words(raw, self.offsets)
        self.null = np.array([i is None for i in self.ids])
        self.key = np.array([0 if i is None else i for i in self.ids], np.int64)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of the windows and the ids of their documents."""
        at = self.words.windows(size)
        at = at[~self.null[self.words.doc[at]]]
        return at, self.key[self.words.doc[at]]

    def dealt(self, size: int, buckets: int):
        """Windows, their documents; distinct anchors by bucket, whether each
        stands in several documents; per window the place of its anchor."""
        at, doc = self.windows(size)
        anchor = self.words.anchors(at, size)
        keys, _, low, high = least(anchor, doc)
        bucket = ((keys >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        return at, doc, keys[order], bucket[order], (low != high)[order], place[np.searchsorted(keys, anchor)]


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, begin and end of each run of equal values."""
    if len(values):
        cut = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True])
        for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
            yield int(values[a]), a, z


def _blobs(parts: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), kind) for x in parts]


def anchor_rows(slices: DataFrame, size: int, buckets: int) -> DataFrame:
    """``bucket, slice, keys``: 31 bits of each distinct anchor, and one that says
    whether it stands in several documents of the slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                s = Slice(batch.slice(r, 1))
                _, _, keys, bucket, several, _ = s.dealt(size, buckets)
                value = (keys & np.uint64(0x7FFFFFFF)).astype(np.uint32) | (several.astype(np.uint32) << np.uint32(31))
                out = [(b, s.id, value[a:z].tobytes()) for b, a, z in _runs(bucket)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary()))],
                        ["bucket", "slice", "keys"])

    return slices.select("slice", "ids", "sizes", "body", "n_bytes").mapInArrow(run, "bucket int, slice long, keys binary")


def repeated_anchors(rows: DataFrame) -> DataFrame:
    """``slice, bucket, bits``: which anchors of a slice stand in several documents."""
    def run(t: pa.Table) -> pa.Table:
        parts = _blobs(t.column("keys"), np.uint32)
        value = np.concatenate(parts)
        keys, back, n = np.unique(value & np.uint32(0x7FFFFFFF), return_inverse=True, return_counts=True)
        yes = (n[back] > 1) | (value >> np.uint32(31) == 1)
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        bits = [np.packbits(x).tobytes() for x in np.split(yes, cuts)]
        some = np.array([bool(x.any()) for x in np.split(yes, cuts)])
        out = pa.table([t.column("slice"), t.column("bucket"), pa.array(bits, pa.binary())], ["slice", "bucket", "bits"])
        return out.filter(pa.array(some))

    return rows.groupBy("bucket").applyInArrow(run, "slice long, bucket int, bits binary")


def prefix_lengths(info: np.ndarray, at: np.ndarray, size: int, need: int) -> np.ndarray:
    """Words of the shortest prefix of each suffix that carries ``need`` units of
    information, ``size`` at most; it depends on no word behind it."""
    if not len(at):
        return at
    sums = np.concatenate([[0], np.cumsum(info)])          # integers: equal everywhere
    near = np.lib.stride_tricks.sliding_window_view(sums, size + 1)[at]
    enough = near[:, 1:] - near[:, :1] >= need
    return np.where(enough.any(1), enough.argmax(1) + 1, size)


def suffix_rows(slices: DataFrame, bits_of: DataFrame, size: int, buckets: int, groups: int, info) -> DataFrame:
    """``group, slice, codes, h, doc``: the distinct suffixes with a repeated anchor."""
    need = int((np.log2(groups) + 4) * UNIT)               # a prefix is about a 16th of a group

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["group", "slice", "codes", "h", "doc"]
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names)
        s = Slice(left)
        at, doc, keys, bucket, _, place = s.dealt(size, buckets)
        flag = np.zeros(len(keys), bool)
        bits = dict(zip(right.column("bucket").to_pylist(), right.column("bits")))
        for b, a, z in _runs(bucket):
            if b in bits:
                flag[a:z] = np.unpackbits(np.frombuffer(bits[b].as_py(), np.uint8), count=z - a).astype(bool)
        on = flag[place] if len(keys) else np.empty(0, bool)
        at, doc = at[on], doc[on]
        h, first, low, _ = least(s.words.span(at, size), doc)
        at = at[first]
        order = np.argsort(at)                        # in text order: equal documents stand together
        at, h, low = at[order], h[order], low[order]
        w = s.words
        long = prefix_lengths(info.value[(w.h % np.uint64(BINS)).astype(np.int64)], at, size, need)
        group = (w.span(at, long) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        at, h, low, group = at[order], h[order], low[order], group[order]
        codes = (w.h & np.uint64(0xFF)).astype(np.uint8)
        out = [(g, s.id, codes[at[a:z, None] + np.arange(size)].tobytes(), h[a:z].tobytes(), low[a:z].tobytes())
               for g, a, z in _runs(group)]
        cols = list(zip(*out)) or [()] * 5
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    left = slices.select("slice", "ids", "sizes", "body", "n_bytes")
    return left.groupBy("slice").cogroup(bits_of.groupBy("slice")).applyInArrow(
        run, "group int, slice long, codes binary, h binary, doc binary")


def deep_nodes(codes: np.ndarray, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix tree of a group, as sorted suffixes and LCPs, cut at ``size``
    words: the order of the suffixes and the first of each node of that depth."""
    text = np.concatenate([codes.reshape(len(h), -1), h.astype(">u8").view(np.uint8).reshape(len(h), 8)], 1)
    order = np.argsort(np.ascontiguousarray(text).view(f"V{text.shape[1]}").ravel(), kind="stable")
    words = codes.reshape(len(h), size)[order]
    same = words[1:] == words[:-1]
    lcp = np.where(same.all(1), size, same.argmin(1)) if len(same) else np.empty(0, np.int64)
    parts = (lcp < size) | (h[order][1:] != h[order][:-1])
    return order, np.flatnonzero(np.r_[True, parts])


def owners(rows: DataFrame, size: int) -> DataFrame:
    """``slice, h, owner``: windows that start in a smaller document than any of the slice's own."""
    def run(t: pa.Table) -> pa.Table:
        codes = np.concatenate(_blobs(t.column("codes"), np.uint8))
        hs, docs = _blobs(t.column("h"), np.uint64), _blobs(t.column("doc"), np.int64)
        h, doc = np.concatenate(hs), np.concatenate(docs)
        order, start = deep_nodes(codes, h, size)
        low = np.minimum.reduceat(doc[order], start)
        owner = np.empty(len(h), np.int64)
        owner[order] = np.repeat(low, np.diff(np.r_[start, len(h)]))
        cuts = np.cumsum([len(x) for x in hs])[:-1]
        out = []
        for s, hh, dd, oo in zip(t.column("slice").to_pylist(), hs, docs, np.split(owner, cuts)):
            lost = oo < dd
            if lost.any():
                out.append((s, hh[lost].tobytes(), oo[lost].tobytes()))
        cols = list(zip(*out)) or [()] * 3
        return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.binary(), pa.binary()))],
                        ["slice", "h", "owner"])

    return rows.groupBy("group").applyInArrow(run, "slice long, h binary, owner binary")


def _joined(w: Words, keep: np.ndarray, n_docs: int) -> pa.Array:
    """Per document its kept words, one space between them."""
    begin, end, doc = w.begin[keep], w.end[keep], w.doc[keep]
    size = end - begin + 1                            # with a space behind each word
    out_at = np.concatenate([[0], np.cumsum(size)])
    out = np.full(int(out_at[-1]), 0x20, np.uint8)
    body = np.ones(len(out), bool)
    body[out_at[1:] - 1] = False
    src = np.arange(len(out)) + np.repeat(begin - out_at[:-1], size)
    out[body] = w.raw[src[body]]
    cut = out_at[np.searchsorted(doc, np.arange(n_docs + 1))]
    return pa.array([out[a:max(a, z - 1)].tobytes().decode() for a, z in zip(cut[:-1], cut[1:])], pa.string())


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed, spans`` (maximal repeated spans that
    go, in words, end exclusive) and ``kept`` (the other words)."""
    spark = docs.sparkSession
    slices = materialize(pack(docs, id_col, text_col), "repeat-slices")
    n_words = slices.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    count = np.ones(BINS)
    for r in slices.select(F.posexplode("bins").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n")).collect():
        count[r["bin"]] += r["n"]
    info = spark.sparkContext.broadcast(             # BINS numbers, whatever the table
        np.round(np.log2(count.sum() / count) * UNIT).astype(np.int64))
    groups = max(MIN_GROUPS, n_words // GROUP)

    bits = repeated_anchors(anchor_rows(slices, window, groups))
    found = owners(suffix_rows(slices, bits, window, groups, groups, info), window)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        s = Slice(left)
        w, n = s.words, len(s.ids)
        at, doc = s.windows(window)
        h = w.span(at, window)
        keys, _, low, _ = least(h, doc)
        for x, o in zip(_blobs(right.column("h"), np.uint64), _blobs(right.column("owner"), np.int64)):
            k = np.searchsorted(keys, x)
            low[k] = np.minimum(low[k], o)
        lost = at[doc > low[np.searchsorted(keys, h)]] if len(at) else at
        cover = np.zeros(len(w.h) + 1, np.int64)
        np.add.at(cover, lost, 1)
        np.add.at(cover, lost + window, -1)
        gone = np.cumsum(cover)[:-1] > 0
        # Consecutive windows of one document make one maximal span.
        edge = np.flatnonzero(gone & np.r_[True, ~gone[:-1] | (w.doc[1:] != w.doc[:-1])]) if len(gone) else np.empty(0, int)
        stop = np.flatnonzero(gone & np.r_[~gone[1:] | (w.doc[1:] != w.doc[:-1]), True]) + 1 if len(gone) else edge
        base = np.searchsorted(w.doc, np.arange(n + 1))
        spans = [[] for _ in range(n)]
        for a, z in zip(edge.tolist(), stop.tolist()):
            d = w.doc[a]
            spans[d].append({"start": a - int(base[d]), "end": z - int(base[d])})
        total = np.bincount(w.doc, minlength=n)
        removed = np.bincount(w.doc[gone], minlength=n)
        return pa.table([pa.array(s.ids, pa.int64()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                         _joined(w, ~gone, n)],
                        ["doc_id", "n_words", "n_removed", "spans", "kept"])

    left = slices.select("slice", "ids", "sizes", "body", "n_bytes")
    return left.groupBy("slice").cogroup(found.groupBy("slice")).applyInArrow(
        run, "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept string")


#: DuckDB: the same over the documents table.
ORACLE = r"""
WITH t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), v AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 12], ' ')) AS h
  FROM t, unnest(range(1, len(w) - 11)) AS u(i)
), o AS (
  SELECT h, min(doc_id) AS owner FROM v GROUP BY h HAVING count(DISTINCT doc_id) > 1
), g AS (
  SELECT doc_id, list(DISTINCT i + j) AS gone
  FROM v JOIN o ON v.h = o.h AND v.doc_id > o.owner, unnest(range(0, 13)) AS u(j) GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, k: gone IS NULL OR NOT list_contains(gone, k)), ' ')) AS kept_sha256
FROM t LEFT JOIN g USING (doc_id)
"""
