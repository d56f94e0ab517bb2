"""Shared helpers of the training-data operators.

``map_texts`` runs a NumPy function over whole texts in bounded Arrow slices;
``words_of`` finds and hashes every word of a slice without building Python
strings, so a very long text costs memory in proportion to one slice or to
that one text, never to a partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of text that one NumPy step works on (unless one text is longer).
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str, mod: int) -> F.Column:
    """crc32 of the id as text, modulo ``mod`` (null ids: null)."""
    return F.crc32(F.col(doc_id).cast("string")) % mod


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: F.Column,
                    max_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most ``max_rows`` labelled texts (``doc_id, y, text``): the first ones
    by md5 of the id, so the same rows at every partitioning.

    Null labels, null ids and rows outside ``keep`` are left out; a label given
    more than once counts as its largest value, a repeated document as its
    smallest text.  The id list is at most ``max_rows`` longs, so it is broadcast.
    """
    ids = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
           .select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
           .where(keep)
           .groupBy("doc_id").agg(F.max("y").alias("y"))
           .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(max_rows))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (texts.join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id", "y").agg(F.min("text").alias("text")))


def slices(batch: pa.RecordBatch, text_col: str, limit: int = SLICE_BYTES
           ) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts total about ``limit`` bytes."""
    n = batch.num_rows
    if n == 0:
        return
    col = batch.column(batch.schema.get_field_index(text_col))
    size = np.asarray(pc.fill_null(pc.binary_length(col), 0), np.int64)
    run = np.cumsum(size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1), n]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its rows (null: empty)."""
    col = col.cast(pa.large_binary()) if not pa.types.is_large_binary(col.type) else col
    col = pc.fill_null(col, b"")
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def map_texts(df: DataFrame, fields: dict[str, str], fn: Callable[..., dict],
              text_col: str = "text") -> DataFrame:
    """Replace the text column by ``fields`` (name -> SQL type), computed by
    ``fn(text column as an Arrow array) -> {name: array}`` slice by slice.  Other
    columns pass through; one that is named like a field is replaced."""
    df = df.drop(*(n for n in fields if n != text_col))
    keep = [f for f in df.schema.fields if f.name != text_col]
    schema = T.StructType(keep + [T.StructField(n, T._parse_datatype_string(t))
                                  for n, t in fields.items()])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                out = fn(part.column(part.schema.get_field_index(text_col)))
                cols = [part.column(part.schema.get_field_index(f.name)) for f in keep]
                cols += [pa.array(out[n], arrow.field(n).type) for n in fields]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


# ----------------------------------------------------------------- words
def byte_map(is_word: Callable[[int], bool], lower: bool = True) -> np.ndarray:
    """256-entry map: word bytes (A-Z lower-cased) to themselves, others to 0."""
    out = np.zeros(256, np.uint8)
    for b in range(1, 256):
        c = b + 32 if lower and 0x41 <= b <= 0x5A else b
        out[b] = c if is_word(c) else 0
    return out


#: Words of letters, digits and all non-ASCII characters.
ALNUM = byte_map(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)

_P = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: int, n: int, cache: dict = {}) -> np.ndarray:  # noqa: B006
    have = cache.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            np.cumprod(have, out=have)
        if size <= 1 << 23:
            cache[base] = have
    return have[:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (each input bit reaches each output bit)."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(30))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(27))
        h = h * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray, chunk: int = SLICE_BYTES
               ) -> np.ndarray:
    """Hash of ``data[begin:end]`` for ascending spans that do not overlap.

    A polynomial in 64-bit integers over random byte values, finalised; equal
    spans have equal hashes on every machine.
    """
    hashes = np.empty(len(begin), np.uint64)
    done = 0
    while done < len(begin):         # bounded steps of about ``chunk`` bytes
        last = max(done + 1, int(np.searchsorted(end, begin[done] + chunk, "right")))
        a, z = int(begin[done]), int(end[last - 1])
        with np.errstate(over="ignore"):
            sums = np.zeros(z - a + 1, np.uint64)
            np.cumsum(_BYTE[data[a:z]] * _powers(_P, z - a), out=sums[1:])
            s, e = begin[done:last] - a, end[done:last] - a
            hashes[done:last] = mix64((sums[e] - sums[s]) * _powers(_P_INV, z - a + 1)[s]
                                      + (e - s).astype(np.uint64))
        done = last
    return hashes


def words_of(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray, chunk: int = SLICE_BYTES
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte, last byte (exclusive) and row of every word.

    A word is a run of bytes that ``table`` does not map to 0, within one row.
    """
    mapped = table[raw]
    on = mapped != 0
    edge = np.zeros(len(raw) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = on[1:] != on[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    begin, end = cuts[:-1], cuts[1:]
    good = on[begin] if len(begin) else np.empty(0, bool)
    begin, end = begin[good], end[good]
    hashes = hash_spans(mapped, begin, end, chunk)
    row = np.searchsorted(offsets, begin, "right") - 1
    return hashes, begin, end, row
