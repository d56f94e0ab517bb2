"""SimHash near-duplicates by the generalised pigeonhole principle (operator 10).

The 64-bit fingerprint of a text has a bit set where more than half of the XXH64
hashes (seed 42) of its word shingles have it.  Two fingerprints link when they
differ in at most ``max_bits`` bits; documents that are linked, directly or over
others, form a component.

The search runs over distinct fingerprints (copies share one).  The 64 bits are dealt into groups of correlated bits, taken from the
agreement of all fingerprints (one 64 x 64 sum).  A threshold t_i >= -1 per group
with sum ``max_bits - groups + 1`` finds every pair: some group must differ in
at most t_i bits (-1: the group is not probed).  Dynamic programming takes the
thresholds with the fewest estimated candidates, from the exact counts of equal
values of each group over all fingerprints.  Fingerprints meet on keys (group,
bits left out, value of the others); within one key they are compared by
XOR and bit count, and only the links of a spanning forest leave the task.

Keys with more than ``HEAVY`` fingerprints are split before the shuffle: their
fingerprints agree on one group, so the pigeonhole is applied again to the other bits
and each takes several finer keys.  No group is dropped, capped or sampled, and
nothing but the 64 x 64 sums, a few counts and the heavy keys' numbers reaches the
driver.  Components come from rounds of large-star and small-star over the
links, each written to the shared folder.

Defined results: a text without words (null, empty, blank) has fingerprint zero
and is linked like any other; a text of fewer words than a shingle is one
shingle; repeated rows link; a component of null ids only has a null
component id; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import map_texts
from strata.session import materialize, release

SHINGLE, MAX_BITS = 3, 2
#: Fingerprints of one key that a task compares; beyond it the key is split.
HEAVY = 4096
#: Cost of shuffling one key, in comparisons of two fingerprints.
KEY_COST = 200.0
#: Shingles whose bits are counted at once (64 bytes each).
STEP = 1 << 16
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
_SPACE = {c: " " for c in (9, 10, 11, 12, 13)}


# ------------------------------------------------------------ fingerprints
def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, as an unsigned integer."""
    from xxhash import xxh64_intdigest
    words = [w for w in (text or "").translate(_TABLE).encode("utf-8").split(b" ") if w]
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, STEP):
        k = min(STEP, n - a)
        cut = words[a:a + k + shingle - 1]
        runs = map(b" ".join, zip(*(cut[i:] for i in range(shingle)))) if len(words) >= shingle \
            else [b" ".join(words)]
        h = np.fromiter((xxh64_intdigest(s, 42) for s in runs), np.uint64, k)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(k, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


_TABLE = {**_LOWER, **_SPACE}


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Replace the text by ``fp`` (the 64 bits as a signed long)."""
    def run(col: pa.Array) -> dict:
        got = np.array([fingerprint(t, shingle) for t in col.to_pylist()], np.uint64)
        return {"fp": got.view(np.int64)}

    return map_texts(docs, {"fp": "long"}, run, text_col)


# -------------------------------------------------------- groups and thresholds
def agreement(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each pair of bits, how many have both."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((64, 64))
        for b in batches:
            for a in range(0, b.num_rows, 1 << 16):
                v = np.asarray(b.column(0).slice(a, 1 << 16)).astype("<i8")
                bits = np.unpackbits(v.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                both += bits.T @ bits
                n += len(v)
        yield pa.RecordBatch.from_pydict({"n": [n], "both": [both.ravel()]})

    per_task = fps.select("fp").mapInArrow(run, "n long, both array<double>")
    sums = (per_task.select("n", F.posexplode("both")).groupBy("pos")
            .agg(F.sum("n").alias("n"), F.sum("col").alias("s")).collect())
    both = np.zeros(64 * 64)
    for r in sums:
        both[r["pos"]] = r["s"]
    return (sums[0]["n"] if sums else 0), both.reshape(64, 64)


def correlated_groups(n: int, both: np.ndarray, groups: int) -> list[list[int]]:
    """Deal 64 bits into equal groups, greedily by absolute correlation."""
    p = both.diagonal() / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, out = set(range(64)), []
    for g in range(groups):
        size = (64 - sum(map(len, out))) // (groups - g)
        seed = max(sorted(free), key=lambda b: corr[b, sorted(free)].sum())
        own = [seed]
        free.remove(seed)
        while len(own) < size:
            best = max(sorted(free), key=lambda b: corr[b, own].sum())
            own.append(best)
            free.remove(best)
        out.append(sorted(own))
    return out


def thresholds(candidates: list[list[float]], total: int) -> tuple[list[int], float]:
    """Dynamic programming: thresholds from -1 on with the given sum and the least
    cost; ``candidates[i][t]`` is the cost of threshold t in group i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for costs in candidates:
        new: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for t in range(-1, len(costs)):
                cost = c + (costs[t] if t >= 0 else 0.0)
                if s + t not in new or cost < new[s + t][0]:
                    new[s + t] = (cost, [*ts, t])
        best = new
    cost, ts = best[total]
    return ts, cost


def _masks(group: list[int], t: int) -> list[int]:
    """The key masks of a group: its bits without every choice of t of them."""
    full = sum(1 << b for b in group)
    return [full & ~sum(1 << b for b in out) for out in itertools.combinations(group, t)]


def plan(fps: DataFrame, max_bits: int = MAX_BITS) -> list[int]:
    """The key masks: two fingerprints within ``max_bits`` agree under one of them."""
    n, both = agreement(fps)
    p = both.diagonal() / max(n, 1)
    apart = 2 * p * (1 - p)                        # chance that a bit differs
    odds = apart / np.maximum(1 - apart, 1e-9)
    best: tuple[float, list[int]] | None = None
    for m in range(2, max(2, max_bits + 1) + 1):
        groups = correlated_groups(n, both, m)
        costs = []
        for g, pairs in zip(groups, _equal_pairs(fps, groups)):
            differ = np.array([1.0])                # pairs that differ in exactly t bits of the group
            for b in g:
                differ = np.convolve(differ, [1.0, odds[b]])[:max_bits + 1]
            costs.append([pairs * differ[:t + 1].sum() + KEY_COST * n * len(_masks(g, t))
                          for t in range(max_bits + 1)])
        ts, cost = thresholds(costs, max_bits - m + 1)
        if best is None or cost < best[0]:
            best = (cost, [k for g, t in zip(groups, ts) if t >= 0 for k in _masks(g, t)])
    return best[1]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _equal_pairs(fps: DataFrame, groups: list[list[int]]) -> list[float]:
    """Per group, the number of pairs with the same value, over all fingerprints."""
    keyed = _keyed(fps, [sum(1 << b for b in g) for g in groups])
    counts = keyed.groupBy("slot", "value").count()
    rows = counts.groupBy("slot").agg(
        F.sum(F.col("count").cast("double") * (F.col("count") - 1)).alias("pairs")).collect()
    by = {r["slot"]: r["pairs"] for r in rows}
    return [by.get(i, 0.0) for i in range(len(groups))]


def _keyed(fps: DataFrame, masks: list[int]) -> DataFrame:
    """``slot, value, fp``: the fingerprint under each mask."""
    values = F.array(*(F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks))
    return fps.select("fp", F.posexplode(values).alias("slot", "value"))


# ------------------------------------------------------------------- links
def _forest(v: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among some fingerprints (sorted, distinct)."""
    n = len(v)
    left, src, dst = np.arange(n), [], []
    while len(left):                                # breadth first from the smallest that is left
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            reached = []
            for f in front:
                near = np.bitwise_count(v[left] ^ v[f]) <= max_bits
                if near.any():
                    got = left[near]
                    left = left[~near]
                    src.append(np.full(len(got), f))
                    dst.append(got)
                    reached.append(got)
                    if not len(left):
                        break
            front = np.concatenate(reached) if reached else np.empty(0, np.int64)
    if not src:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return v[np.concatenate(src)], v[np.concatenate(dst)]


def links(fps: DataFrame, max_bits: int = MAX_BITS, heavy: int = HEAVY) -> DataFrame:
    """Links ``a, b`` among distinct fingerprints (column ``fp``) that join all
    that are within ``max_bits`` of each other, directly or over others."""
    masks = plan(fps, max_bits)
    keyed = _keyed(fps, masks)
    # Heavy keys are finer keys of their own: agree on the mask, and by the
    # pigeonhole on one of max_bits + 1 parts of the other bits.
    big = (keyed.groupBy("slot", "value").count().where(F.col("count") > heavy)
           .select(F.col("slot").alias("hslot"), F.col("value").alias("hvalue")))
    finer = []
    for m in masks:
        rest = [b for b in range(64) if not m >> b & 1]
        finer.append([_signed(m | sum(1 << b for b in rest[i::max_bits + 1])) for i in range(max_bits + 1)])
    sub = F.element_at(F.array(*(F.array(*(F.lit(x) for x in f)) for f in finer)), F.col("slot") + 1)
    split = keyed.join(big, (F.col("slot") == F.col("hslot")) & (F.col("value") == F.col("hvalue")), "left")
    ready = split.select("fp", "slot", F.explode(F.when(
        F.col("hslot").isNull(), F.array(F.struct(F.lit(-1).alias("part"), F.col("value").alias("key"))))
        .otherwise(F.transform(sub, lambda m, i: F.struct(
            i.alias("part"), F.col("fp").bitwiseAND(m).alias("key"))))).alias("k"))
    dealt = (ready.select("fp", (F.col("slot") * 8 + F.col("k.part")).alias("slot"), F.col("k.key").alias("key"))
             .repartition("slot", "key").sortWithinPartitions("slot", "key", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.empty((3, 0), np.int64)]

        def close(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            edge = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)) + 1
            cuts = np.concatenate([[0], edge, [rows.shape[1]]])
            a_out, b_out = [], []
            for i in np.flatnonzero(np.diff(cuts) > 1):
                a, b = _forest(rows[2, cuts[i]:cuts[i + 1]].view(np.uint64), max_bits)
                if len(a):
                    a_out.append(a)
                    b_out.append(b)
            if a_out:
                yield pa.RecordBatch.from_pydict({"a": np.concatenate(a_out).view(np.int64),
                                                  "b": np.concatenate(b_out).view(np.int64)})

        for batch in batches:
            rows = np.stack([np.asarray(batch.column(n)).astype(np.int64) for n in ("slot", "key", "fp")])
            if not rows.shape[1]:
                continue
            last = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1])
            whole = np.concatenate([*held, rows[:, ~last]], axis=1)
            if (~last).any():
                yield from close(np.ascontiguousarray(whole))
                held = [rows[:, last]]
            elif whole.shape[1] and (whole[0, -1] != rows[0, 0] or whole[1, -1] != rows[1, 0]):
                yield from close(np.ascontiguousarray(whole))
                held = [rows]
            else:
                held.append(rows)
        yield from close(np.ascontiguousarray(np.concatenate(held, axis=1)))

    return dealt.mapInArrow(run, "a long, b long")


# -------------------------------------------------------------- components
def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root``: the smallest node of the component of every linked node.

    Large-star and small-star rounds until nothing changes: every node points
    its larger (then all) neighbours at its smallest neighbour.  A node with very
    many neighbours is aggregated map-side; each round is written and read back.
    """
    edges = materialize(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(down.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        new = materialize(small, "links")
        same = (new.exceptAll(edges).limit(1).count() == 0) and (edges.exceptAll(new).limit(1).count() == 0)
        release(edges)                       # the next round is written, so this one is done
        edges = new
        if same:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS, heavy: int = HEAVY,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """The id (and columns ``keep``) of every row, plus ``fp``, ``root`` (the component's
    smallest fingerprint) and ``component_id``: the smallest id that is reachable
    over links, the row's own included."""
    rows = docs.select(id_col, *keep, text_col)
    marked = materialize(fingerprints(rows, text_col, shingle), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min(id_col).alias("low")), "distinct")
    roots = components(links(distinct, max_bits, heavy))
    # Linked fingerprints take the smallest id of their component.
    member = (distinct.join(roots, distinct.fp == roots.node, "left")
              .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    low = member.groupBy("root").agg(F.min("low").alias("component_id"))
    owner = member.select("fp", "root").join(low, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    return marked.join(owner, marked.fp == F.col("_fp")).drop("_fp")


def hex16(fp: str) -> F.Column:
    """The 64 bits as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
