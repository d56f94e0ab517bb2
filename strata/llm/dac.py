"""Token ids as files of directly addressable codes (operator 3).

A block of ids is split into 8-bit chunk levels.  Level 0 holds the low chunk of
every id and one bit per id that says whether more chunks follow; level k + 1
holds the next chunk of those ids only.  A rank directory (ones before each 512
bits) turns the position of an id on one level into its position on the next, so
any id is read from a few bytes, without decoding the block.

Documents are range-partitioned and sorted by id (ties: by text), each partition is tokenised
after the shuffle (text travels once, ids never do), and every ~1M ids become
one row of a Parquet table in the shared folder: (part, seq, start in the part,
document ids and lengths, levels).  Spark's task commit makes the files survive
lost executors.  The starts of parts are a prefix sum over one total per part.

Defined results: null and empty texts are the end id alone; repeated ids keep
one entry per row; null ids come first; an empty table writes no block; a text
longer than a block gets a block of its own size; an added token of the tokenizer's
file that stands in a text gives its id, as in the tokenizer's own call.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.llm.common import hash_spans, slices, utf8

CHUNK_BITS = 8
RANK_BITS = 512
BLOCK_IDS = 1 << 20
END_ID = 0


# ------------------------------------------------------------------ codec
def encode(ids: np.ndarray) -> list[tuple[bytes, bytes, bytes]]:
    """Levels (chunks, continuation bits, rank directory) of unsigned ids."""
    rest, levels = np.asarray(ids, np.uint64), []
    while True:
        more = rest >= (1 << CHUNK_BITS)
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.int64) \
            if len(more) else np.zeros(0, np.int64)
        rank = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4") if len(ones) else ones.astype("<u4")
        levels.append(((rest & np.uint64(255)).astype(np.uint8).tobytes(), bits.tobytes(), rank.tobytes()))
        if not more.any():
            return levels
        rest = rest[more] >> np.uint64(CHUNK_BITS)


def decode(levels: list) -> np.ndarray:
    """All ids of a block."""
    out = np.frombuffer(levels[0][0], np.uint8).astype(np.uint32)
    at = np.arange(len(out))
    for k in range(1, len(levels)):
        more = np.unpackbits(np.frombuffer(levels[k - 1][1], np.uint8), count=len(at),
                             bitorder="little").astype(bool)
        at = at[more]
        out[at] |= np.frombuffer(levels[k][0], np.uint8).astype(np.uint32) << np.uint32(CHUNK_BITS * k)
    return out


def take(levels: list, positions: np.ndarray) -> np.ndarray:
    """The ids at some positions: per level one chunk, one bit and at most 512
    bits counted from the rank directory are read; nothing else is decoded."""
    pos = np.asarray(positions, np.int64).copy()
    out = np.zeros(len(pos), np.uint32)
    live = np.arange(len(pos))
    for k, (chunks, bits, ranks) in enumerate(levels):
        here = pos[live]
        out[live] |= np.frombuffer(chunks, np.uint8)[here].astype(np.uint32) << np.uint32(CHUNK_BITS * k)
        bit = np.frombuffer(bits, np.uint8)
        on = (bit[here >> 3] >> (here & 7).astype(np.uint8)) & 1 == 1
        live, here = live[on], here[on]
        directory = np.frombuffer(ranks, "<u4")
        step = RANK_BITS // 8
        for i, p in zip(live, here):
            first = (p // RANK_BITS) * step
            run = np.unpackbits(bit[first:first + step], bitorder="little")
            pos[i] = int(directory[p // RANK_BITS]) + int(run[:p % RANK_BITS].sum())
        if not len(live):
            break
    return out


# -------------------------------------------------------------- tokenising
#: The byte-level alphabet: a byte that prints stands for itself, the others for
#: the letters from U+0100 on, in order.
_PLAIN = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
_LETTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}


class PieceEncoder:
    """Token ids of whole texts, one tokenizer call per distinct piece.

    The byte-level pre-tokenizer never puts a token across a blank that stands
    alone between two other characters, so a text is cut there (the blank goes
    with what follows) and the ids of its pieces are joined.  Pieces are found
    and hashed on the bytes of a slice; the ids of at most ``keep`` pieces, none
    longer than 64 bytes, are remembered in flat arrays sorted by hash.

    The added tokens of the file are cut out of a text first, as the tokenizer
    does, and stand for their ids.
    """

    def __init__(self, path: str, keep: int = 1_000_000):
        from tokenizers import Tokenizer
        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.single_word or t.lstrip or t.rstrip for t in added.values()) \
                or (self.tokenizer.normalizer is not None and any(t.normalized for t in added.values())):
            raise ValueError("added tokens that strip blanks, match whole words or are normalised")
        self.added = {t.content: i for i, t in added.items() if t.content}
        longest = sorted((c.encode() for c in self.added), key=len, reverse=True)
        self.find_added = re.compile(b"|".join(map(re.escape, longest))).finditer if longest else lambda data: ()
        self._forget()

    def _added_spans(self, data: bytes, offsets: np.ndarray) -> np.ndarray:
        """First and last byte (exclusive) of every added token within a text."""
        rows: set[int] = set()
        for m in self.find_added(data):         # may lie across texts, so only tells which to look at
            a, z = np.searchsorted(offsets, [m.start(), m.end() - 1], "right") - 1
            rows.update(range(a, z + 1))
        return np.array([(offsets[r] + m.start(), offsets[r] + m.end()) for r in sorted(rows)
                         for m in self.find_added(data[offsets[r]:offsets[r + 1]])], np.int64).reshape(-1, 2)

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.at, self.size = np.empty(0, np.int32), np.empty(0, np.int32)
        self.flat = np.empty(0, np.int32)

    def _tokenise(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in one array, and how many each has.

        A piece of Latin letters, a blank before them or not, is one unit of the
        pre-tokenizer, so it goes to the model directly; others take the full path."""
        found: list = [None] * len(pieces)
        model, rest = self.tokenizer.model.tokenize, []
        for i, p in enumerate(pieces):
            w = p[1:] if p[0] == " " else p
            if p in self.added:
                found[i] = [self.added[p]]
            elif w.isalpha() and (w.isascii() or max(w) < "\u0250"):
                found[i] = [t.id for t in model(p.encode().decode("latin-1").translate(_LETTERS))]
            else:
                rest.append(i)
        for a in range(0, len(rest), 4096):
            some = rest[a:a + 4096]
            got = self.tokenizer.encode_batch_fast([pieces[i] for i in some], add_special_tokens=False)
            for i, e in zip(some, got):
                found[i] = e.ids
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.int32, int(size.sum())), size

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and how many each text has."""
        raw, offsets = utf8(col)
        data = raw.tobytes()
        spans = self._added_spans(data, offsets)
        begin = piece_starts(raw, np.unique(np.append(offsets, spans)) if len(spans) else offsets)
        if len(spans):                              # an added token is one piece
            last = np.searchsorted(spans[:, 0], begin, "left") - 1
            begin = begin[(last < 0) | (begin >= spans[last, 1])]
        end = np.append(begin[1:], len(raw))
        row = np.searchsorted(offsets, begin, "right") - 1
        h, first, inverse = np.unique(hash_spans(raw, begin, end), return_index=True,
                                      return_inverse=True)
        spot = np.searchsorted(self.known, h)
        have = np.zeros(len(h), bool)
        inside = spot < len(self.known)
        have[inside] = self.known[spot[inside]] == h[inside]
        fresh = np.flatnonzero(~have)
        at, size = np.empty(len(h), np.int64), np.empty(len(h), np.int64)
        at[have], size[have] = self.at[spot[have]], self.size[spot[have]]
        b, e = begin[first[fresh]], end[first[fresh]]
        new, n = self._tokenise([data[x:y].decode() for x, y in zip(b.tolist(), e.tolist())])
        at[fresh], size[fresh] = len(self.flat) + np.cumsum(n) - n, n
        flat = np.concatenate([self.flat, new])
        per = size[inverse]
        total = int(per.sum())
        start = np.cumsum(per) - per
        ids = flat[np.repeat(at[inverse] - start, per) + np.arange(total)]
        short = fresh[(e - b) <= 64]
        if len(self.known) + len(short) > self.keep:
            self._forget()
        else:
            where = spot[short]
            self.known = np.insert(self.known, where, h[short])
            self.at = np.insert(self.at, where, at[short])
            self.size = np.insert(self.size, where, size[short])
            self.flat = flat
        return ids, np.bincount(row, per, minlength=len(col)).astype(np.int64)


def piece_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of the pieces: starts of texts, lone blanks, and ends of words
    (an ASCII letter before another ASCII character, so "word," is two pieces)
    and of single line ends before a letter.

    Blanks beside a character that may be wide white space (lead bytes C2, E1,
    E2, E3) are not cut at; a longer piece is tokenised just the same.
    """
    blank = np.isin(raw, np.frombuffer(b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ", np.uint8))
    wide = (raw == 0xC2) | ((raw >= 0xE1) & (raw <= 0xE3))
    at = np.flatnonzero(raw == 0x20)
    at = at[(at > 0) & (at + 1 < len(raw))]
    ok = ~blank[at - 1] & ~blank[at + 1] & ~wide[at + 1]
    for back in (2, 3):
        ok &= ~wide[np.maximum(at - back, 0)]
    cut = np.zeros(len(raw) + 1, bool)
    cut[at[ok]] = True
    lower = raw | 0x20
    letter = (lower >= 0x61) & (lower <= 0x7A)
    cut[1:-1] |= letter[:-1] & ~letter[1:] & ~blank[1:] & (raw[1:] < 0x80)
    line = np.flatnonzero(raw == 0x0A)
    line = line[(line > 0) & (line + 1 < len(raw))]
    line = line[letter[line + 1] & ~blank[line - 1] & ~wide[np.maximum(line - 2, 0)]
                & ~wide[np.maximum(line - 3, 0)]]
    cut[line + 1] = True
    ends = offsets[1:]
    cut[ends[ends < len(raw)]] = True           # starts of the next texts
    cut[np.maximum(ends - 1, 0)] &= np.isin(np.maximum(ends - 1, 0), offsets)  # a final blank stays
    cut[0] = True
    return np.flatnonzero(cut[:-1])


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker (the learned pieces outlive a task)."""
    if path not in _ENCODERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs a task per core
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


# ------------------------------------------------------------------- files
LEVELS = "array<struct<chunks: binary, bits: binary, ranks: binary>>"


def _block(part: int, seq: int, start: int, ids: list, lengths: list, tokens: list,
           schema: pa.Schema) -> pa.RecordBatch:
    flat = np.concatenate(tokens)
    row = {"part": [part], "seq": [seq], "start": [start], "n_ids": [len(flat)], "doc_ids": [ids],
           "lengths": [np.concatenate(lengths).astype("<i8").tobytes()],
           "levels": [[dict(zip(("chunks", "bits", "ranks"), lv)) for lv in encode(flat)]]}
    return pa.RecordBatch.from_pydict(row, schema=schema)


def write(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id",
          text_col: str = "text", end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Tokenise ``docs`` and write the blocks in ascending id order."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    placed = df.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    schema = T._parse_datatype_string(
        f"part int, seq int, start long, n_ids long, doc_ids array<{dict(df.dtypes)['doc_id']}>, "
        f"lengths binary, levels {LEVELS}")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        ids, lengths, tokens, have, seq, start = [], [], [], 0, 0, 0
        for batch in batches:
            for b in slices(batch, "text", 2 << 20):
                flat, n = enc.encode(b.column(1))
                out = np.full(len(flat) + len(n), end_id, np.int32)
                out[np.arange(len(flat)) + np.repeat(np.arange(len(n)), n)] = flat
                ids += b.column(0).to_pylist()
                lengths.append(n + 1)
                tokens.append(out)
                have += len(out)
                if have >= block_ids:
                    yield _block(part, seq, start, ids, lengths, tokens, arrow)
                    ids, lengths, tokens, have, seq, start = [], [], [], 0, seq + 1, start + have
        if ids:
            yield _block(part, seq, start, ids, lengths, tokens, arrow)

    placed.mapInArrow(run, schema).write.parquet(path)


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The written blocks with ``first``, the number of ids before the block.

    One total per written part comes to the driver (as many as write tasks)."""
    df = spark.read.parquet(path)
    totals = sorted((r["part"], r["n"]) for r in
                    df.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, bases = 0, []
    for part, n in totals:
        bases.append((part, before))
        before += n
    base = spark.createDataFrame(bases, "part int, base long")
    return df.join(F.broadcast(base), "part").withColumn("first", F.col("base") + F.col("start")).drop("base")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, decoded from the files: ``doc_id, start, n_tokens, ids``."""
    return _per_doc(blocks(spark, path), "ids array<long>",
                    lambda part: part.astype(np.int64))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, decoded from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    return _per_doc(blocks(spark, path), "ids_crc32 long",
                    lambda part: zlib.crc32(part.astype("<u4").tobytes()))


def _per_doc(df: DataFrame, field: str, fn) -> DataFrame:
    df = df.select("first", "doc_ids", "lengths", "levels")
    kind = dict(df.dtypes)["doc_ids"][len("array<"):-1]
    schema = T._parse_datatype_string(f"doc_id {kind}, start long, n_tokens long, {field}")
    arrow, name = to_arrow_schema(schema), field.split()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                first, docs, lengths, levels = (batch.column(c)[i].as_py() for c in range(4))
                n = np.frombuffer(lengths, "<i8")
                ids = decode([(lv["chunks"], lv["bits"], lv["ranks"]) for lv in levels])
                at = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": docs, "start": first + at[:-1], "n_tokens": n,
                     name: [fn(ids[a:b]) for a, b in zip(at, at[1:])]}, schema=arrow)

    return df.mapInArrow(run, schema)


def lookup(spark: SparkSession, path: str, positions: list[int]) -> DataFrame:
    """``position, id`` of some positions of the whole token stream, read by
    random access in the blocks that hold them (others are pruned by ``first``)."""
    wanted = np.sort(np.asarray(positions, np.int64))
    df = blocks(spark, path).select("first", "n_ids", "levels")
    if len(wanted):
        df = df.where((F.col("first") <= int(wanted[-1])) & (F.col("first") + F.col("n_ids") > int(wanted[0])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                first, n, levels = (batch.column(c)[i].as_py() for c in range(3))
                here = wanted[(wanted >= first) & (wanted < first + n)]
                got = take([(lv["chunks"], lv["bits"], lv["ranks"]) for lv in levels], here - first)
                yield pa.RecordBatch.from_pydict({"position": here, "id": got.astype(np.int64)})

    return df.mapInArrow(run, "position long, id long")
