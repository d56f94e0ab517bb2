"""Conversation structure repair by lightest derivations (operator 11).

A conversation's rows, by turn, get one edit each (Keep, Rerole to user or
assistant, Delete) and rows may be Inserted, so that the initials of the roles read
``(s?(ua)+)?``.  The cheapest edits win; of equally cheap ones the ASCII-least string
of their initials (the audit).

* An item ``(i, q)`` says that the first i rows have been edited and left the
  automaton of that pattern in state q.  Each edit is a deduction whose weight is a
  superior function of (cost, audit): it adds its cost and appends its initial, so
  no conclusion is lighter than its premise.  Two audits of one item at one cost are never
  prefixes of each other (they edit the same rows, and an extra Insert costs), so
  appending keeps their order.  Knuth's agenda pops items lightest first, and
  stops once the goal items are final.
* Conversations of any length: rows are range partitioned in their order and cut into
  segments of ``SEGMENT`` rows, so that no task gets more than its share of a long one.  A segment's
  goals are its lightest derivations from each state it may start in to each state
  it may end in; two neighbours combine (state p to q, then q to r) by the same sum of (cost, audit).
* Only digests of texts are ordered and compared; texts meet their edits in the end.

Faults, the first that holds: blank (no character but white space), duplicate (role
and text seen earlier), truncated (the last character that is no white space is none of
``.!?``).  Blank rows and duplicates must be deleted; an undeleted truncated row costs more.

Defined results: null roles and texts count as one space; null turns come first; rows
of one turn are ordered by role, then by md5 of the text; equal rows stand together, the
first of them may stay; null ids are one conversation; any role may be kept by its first
character alone; texts of any length are read whole; an empty table gives no rows;
other columns are not read.  A conversation's audit is one string, so it must
fit one (2**31 rows); its combination holds 16 letters a row, no texts.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.session import materialize

#: Rows of a segment.
SEGMENT = 512
#: Prices of the edits and of an undeleted truncated row (fixed values).
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States of the pattern: nothing yet, after s, after u, after a.
STATES = "0SUA"
ENDS = "0A"
_WHITE = " \t\n\x0b\x0c\r"


# ------------------------------------------------------------- the agenda
def lightest(axioms: dict, deduce: Callable[[object], Iterable[tuple[object, int, str]]], goals: set) -> dict:
    """Lightest (cost, audit) of every goal item that can be derived.

    ``deduce(item)`` gives (conclusion, cost, initials) of the deductions from an
    item.  Items are popped lightest first; a popped item is final."""
    agenda = [(weight, item) for item, weight in axioms.items()]
    heapq.heapify(agenda)
    best, final, wanted = dict(axioms), {}, set(goals)
    while agenda and wanted:
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        wanted.discard(item)
        for conclusion, cost, letters in deduce(item):
            new = (weight[0] + cost, weight[1] + letters)
            if conclusion not in final and (conclusion not in best or new < best[conclusion]):
                best[conclusion] = new
                heapq.heappush(agenda, (new, conclusion))
    return {g: final[g] for g in goals if g in final}


def kept_state(state: str, initial: str) -> str | None:
    """State after a row whose role has that initial, if it may stand there."""
    if initial == "s" and state == "0":
        return "S"
    if initial == "u" and state in "0SA":
        return "U"
    return "A" if initial == "a" and state == "U" else None


def turned(state: str) -> str:
    """State after a row that was given the role that fits."""
    return "A" if state == "U" else "U"


def edits(rows: list[tuple[str, bool, bool, int]], entry: str) -> dict[str, tuple[int, str]]:
    """Per end state the lightest (cost, audit) of a segment entered in ``entry``.

    Rows: initial, whether it may stay, whether it is truncated, and how many equal
    rows stand there (the further ones must be deleted)."""
    n = len(rows)

    def deduce(item: tuple[int, str]) -> Iterator[tuple[tuple[int, str], int, str]]:
        i, q = item
        yield (i, turned(q)), INSERT, "I"
        if i == n:
            return
        initial, may_stay, cut, copies = rows[i]
        yield (i + 1, q), DELETE * copies, "D" * copies
        if may_stay:
            extra, rest = TRUNCATED * cut + DELETE * (copies - 1), "D" * (copies - 1)
            kept = kept_state(q, initial)
            if kept:
                yield (i + 1, kept), extra, "K" + rest
            yield (i + 1, turned(q)), REROLE + extra, "R" + rest

    found = lightest({(0, entry): (0, "")}, deduce, {(n, q) for q in STATES})
    return {q: w for (_, q), w in found.items()}


def combine(segments: list[dict[tuple[str, str], tuple[int, str]]]) -> tuple[int, str]:
    """Lightest (cost, audit) of a conversation from its segments' derivations.
    What all states' audits have in common is set aside, so the rest stays short."""
    done, now = [], {"0": (0, "")}
    for seg in segments:
        after = {}
        for (p, q), (cost, letters) in seg.items():
            if p in now:
                new = (now[p][0] + cost, now[p][1] + letters)
                if q not in after or new < after[q]:
                    after[q] = new
        common = os.path.commonprefix([a for _, a in after.values()])
        done.append(common)
        now = {q: (c, a[len(common):]) for q, (c, a) in after.items()}
    cost, rest = min(now[q] for q in ENDS if q in now)
    return cost, "".join(done) + rest


def outcome(audit: str, segments: list[tuple[list[str], list[int]]]) -> list[list[dict]]:
    """Per segment (initials and copies of its rows) the rows that the audit leaves:
    ``place``, ``pos`` (null: inserted) and ``role`` (null: as it was)."""
    at, state, names, out = 0, "0", {"U": "user", "A": "assistant"}, []

    def put(left: list[dict], pos: int | None, role: str | None) -> None:
        left.append({"place": len(left), "pos": pos, "role": role})

    for k, (initials, copies) in enumerate(segments):
        left: list[dict] = []
        for pos, n in enumerate(copies):
            while audit[at] == "I":
                state = turned(state)
                put(left, None, names[state])
                at += 1
            if audit[at] == "K":
                state = kept_state(state, initials[pos])
                put(left, pos, None)
            elif audit[at] == "R":
                state = turned(state)
                put(left, pos, names[state])
            at += n
        if k == len(segments) - 1:
            for _ in audit[at:]:
                state = turned(state)
                put(left, None, names[state])
        out.append(left)
    return out


# ------------------------------------------------------------ on Spark
def _key(*cols: str) -> Column:
    """md5 of some columns, nulls told apart from all values."""
    parts = [F.coalesce(F.concat(F.lit("="), F.hex(F.encode(F.col(c).cast("string"), "UTF-8"))), F.lit("-")) for c in cols]
    return F.unhex(F.md5(F.concat_ws(" ", *parts)))


def prepared(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text, digest, row``: nulls as defined, and keys."""
    space = F.lit(" ")
    named = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                         F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"))
    return named.withColumn("digest", F.md5("text")).withColumn("row", _key("conv", "turn", "role", "digest"))


def ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows, without their texts, in the order of their conversations:
    ``seg, pos, opens`` (the segment surely opens its conversation) ``, copies``."""
    bare = F.rtrim(F.col("text"), F.lit(_WHITE))
    flat = rows.select("row", "conv", "turn", "role", "digest", (bare == "").alias("blank"),
                       (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    one = flat.groupBy("row").agg(*(F.first(c).alias(c) for c in flat.columns[1:]), F.count("*").alias("copies"))
    keys = ("conv", "turn", "role", "digest")
    one = one.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = T.StructType([*one.schema.fields, *T._parse_datatype_string("seg long, pos int, opens boolean").fields])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, pos, convs, last = (TaskContext.get().partitionId() << 32) - 1, 0, 0, object()
        where = batch_schema.get_field_index("conv")
        for batch in batches:
            segs, places, opens = [], [], []
            for c in batch.column(where).to_pylist():
                if c != last or pos == SEGMENT:
                    convs, seg, fresh, pos, last = convs + (c != last), seg + 1, c != last and convs > 0, 0, c
                segs.append(seg)
                places.append(pos)
                opens.append(fresh)
                pos += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(segs, pa.int64()), pa.array(places, pa.int32()), pa.array(opens, pa.bool_())],
                names=[*batch.schema.names, "seg", "pos", "opens"])

    batch_schema = to_arrow_schema(one.schema)
    return one.mapInArrow(number, schema)


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Rows of sorted batches, one list for each run of equal keys."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[-1][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _batched(rows: Iterator[dict], schema: pa.Schema, weight: Callable[[dict], int]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows, each of about a million letters or less."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + weight(row)
        if size > 1 << 20:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _conv_type(df: DataFrame) -> str:
    return df.schema["conv"].dataType.simpleString()


def derived(rows: DataFrame) -> DataFrame:
    """One row a segment: counts of its faults, its rows' initials and copies, and
    its lightest derivations (``paths``)."""
    schema = (f"conv {_conv_type(rows)}, seg long, blank long, duplicate long, truncated long, illegal long, "
              "initials array<string>, copies array<long>, "
              "paths array<struct<entry: string, exit: string, cost: long, audit: string>>")
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for group in _grouped(batches, "seg"):
            steps = [(r["role"][:1], r["stays"], r["cut"], r["copies"]) for r in group]
            paths = [{"entry": p, "exit": q, "cost": c, "audit": a}
                     for p in ("0" if group[0]["opens"] else STATES) for q, (c, a) in edits(steps, p).items()]
            initials, copies = [s[0] for s in steps], [s[3] for s in steps]
            total = sum(copies)
            blank = sum(r["copies"] for r in group if r["blank"])
            leads = sum(r["stays"] for r in group)
            yield {"conv": group[0]["conv"], "seg": group[0]["seg"], "blank": blank, "duplicate": total - blank - leads,
                   "truncated": sum(r["stays"] and r["cut"] for r in group),
                   "illegal": total - len(group) + sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])),
                   "initials": initials, "copies": copies, "paths": paths}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(found(batches), arrow, lambda r: sum(len(p["audit"]) for p in r["paths"]))

    first = rows.where(~F.col("blank")).groupBy(_key("conv", "role", "digest").alias("same")) \
        .agg(F.min(F.struct("seg", "pos")).alias("first"))
    flagged = rows.withColumn("same", _key("conv", "role", "digest")).join(first, "same", "left").withColumn(
        "stays", ~F.col("blank") & (F.col("first") == F.struct("seg", "pos")))
    return (flagged.select("conv", "seg", "pos", "opens", "role", "blank", "cut", "copies",
                           F.coalesce("stays", F.lit(False)).alias("stays"))
            .repartition("seg").sortWithinPartitions("seg", "pos").mapInArrow(run, schema))


def decided(segments: DataFrame) -> DataFrame:
    """One row a segment with the rows left of it; a conversation's first segment
    also has its sums, cost and audit (null in the others)."""
    kind = _conv_type(segments)
    sums = ("blank", "duplicate", "truncated", "illegal")
    schema = (f"conv {kind}, seg long, {', '.join(f'{c} long' for c in sums)}, cost long, audit string, "
              "rows array<struct<place: int, pos: int, role: string>>")
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for group in _grouped(batches, "conv"):
            cost, audit = combine([{(p["entry"], p["exit"]): (p["cost"], p["audit"]) for p in g["paths"]} for g in group])
            left = outcome(audit, [(g["initials"], g["copies"]) for g in group])
            total = {c: sum(g[c] for g in group) for c in sums}
            for g, h in zip(group, group[1:]):
                total["illegal"] += g["initials"][-1] + h["initials"][0] not in ("su", "ua", "au")
            for k, (g, rows) in enumerate(zip(group, left)):
                more = {**total, "cost": cost, "audit": audit} if k == 0 else {}
                yield {"conv": g["conv"], "seg": g["seg"], "rows": rows, **more}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(found(batches), arrow, lambda r: len(r.get("audit", "")) + 40 * len(r["rows"]))

    return segments.repartition("conv").sortWithinPartitions("conv", "seg").mapInArrow(run, schema)


class Repaired:
    """``summary``: per conversation ``conv, gaps, blank, duplicate, truncated, illegal,
    cost, audit``; ``rows``: the repaired conversations, ordered by ``seg, place``
    (``conv, seg, place, role, text``, and ``turn``, null for inserted rows)."""

    def __init__(self, turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text"):
        rows = prepared(turns, conv, turn, role, text)
        place = materialize(ordered(rows), "conversation-rows")
        made = materialize(decided(derived(place)), "conversation-edits")
        gaps = place.groupBy(F.col("conv").alias("c")).agg(F.coalesce(
            F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
        self.summary = (made.where(F.col("audit").isNotNull()).join(gaps, F.col("conv").eqNullSafe(F.col("c")))
                        .select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))
        texts = rows.groupBy("row").agg(F.first("text").alias("text"))
        left = (made.select("conv", "seg", F.inline("rows"))
                .join(place.select("seg", "pos", "row", "turn", F.col("role").alias("was")), ["seg", "pos"], "left"))
        self.rows = left.join(texts, "row", "left").select(
            "conv", "seg", "place", "turn", F.coalesce("role", "was").alias("role"),
            F.when(F.col("pos").isNull(), "").otherwise(F.col("text")).alias("text"))


def sha256_of(rows: DataFrame) -> DataFrame:
    """``conv, sha256`` of each repaired conversation's ``role:text`` lines, hashed row
    by row as they stream past: a hash has one order, but no conversation is held."""
    schema = f"conv {_conv_type(rows)}, sha256 string"
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, state = None, None
        for batch in batches:
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if state is None or c != now:
                    if state is not None:
                        yield {"conv": now, "sha256": state.hexdigest()}
                    now, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
        if state is not None:
            yield {"conv": now, "sha256": state.hexdigest()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(found(batches), arrow, lambda r: 64)

    return (rows.repartition("conv").sortWithinPartitions("conv", "seg", "place")
            .select("conv", "role", "text").mapInArrow(run, schema))


# ------------------------------------------------------------- the query's input
def damaged(conversations: DataFrame) -> DataFrame:
    """The query's input: rows dropped, emptied, cut, repeated or given to the user by
    crc32 of ``conv_id:turn`` modulo 20 (0 to 4); nulls are one space."""
    space = F.lit(" ")
    text = lambda c: F.coalesce(F.col(c).cast("string"), space)
    what = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return (conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), what.alias("w"))
            .where("w <> 0")
            .withColumn("text", F.when(F.col("w") == 1, "").when(F.col("w") == 2, F.regexp_replace("text", "[.!?]", ""))
                        .otherwise(F.col("text")))
            .withColumn("role", F.when(F.col("w") == 4, "user").otherwise(F.col("role")))
            .select("conv_id", "turn", "role", "text",
                    F.explode(F.when(F.col("w") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("w"))
            .drop("w"))


def digest(conversations: DataFrame) -> DataFrame:
    """Per original id what was found and done (ids without rows left: zeros)."""
    found = Repaired(damaged(conversations))
    ids = conversations.select("conv_id").distinct()
    sha = sha256_of(found.rows).withColumnRenamed("conv", "c2")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return (ids.join(found.summary, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
            .join(sha, F.col("conv_id").eqNullSafe(F.col("c2")), "left")
            .select("conv_id", *(zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def _oracle() -> str:
    """DuckDB: the same over the conversations table, one step a row for all
    conversations; a state is its cost (nine digits) and audit in one string."""
    def add(x: str, cost: str, letter: str) -> str:
        return f"lpad(CAST(CAST({x}[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {x}[10:] || '{letter}'"

    closed_u = f"least(u, {add('z', '5', 'I')}, {add('s', '5', 'I')}, {add('a', '5', 'I')})"
    before = "least(z, s, a)"
    return rf"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
    FROM range(256) AS r(i))
), n AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                                        lambda x: CAST(ascii(x) AS BIGINT)),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS w
  FROM conversations, crc
), d AS (
  SELECT conv_id, turn, CASE WHEN w = 4 THEN 'user' ELSE role END AS role,
         CASE w WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM n, unnest(range(CASE WHEN w = 3 THEN 2 ELSE 1 END)) AS k(k) WHERE w <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM d
), f AS (
  SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup,
         right(bare, 1) NOT IN ('.', '!', '?') AS cut, role[1] AS r, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS r0
  FROM o
), g AS (
  SELECT *, NOT blank AND NOT dup AS may, CASE WHEN cut THEN 5 ELSE 0 END AS x FROM f
), st AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '000000000' AS z, CAST(NULL AS VARCHAR) AS s, '000000005I' AS u, '000000010II' AS a
  FROM conversations
  UNION ALL
  SELECT conv_id, i, z, s, u1, least(a, {add('u1', '5', 'I')}) FROM (
    SELECT conv_id, i, z, s, a, {closed_u} AS u1 FROM (
      SELECT st.conv_id, g.i, {add('z', '2', 'D')} AS z,
             least({add('s', '2', 'D')}, CASE WHEN may AND r = 's' THEN {add('z', 'x', 'K')} END) AS s,
             least({add('u', '2', 'D')}, CASE WHEN may AND r = 'u' THEN {add(before, 'x', 'K')} END,
                   CASE WHEN may THEN {add(before, '1 + x', 'R')} END) AS u,
             least({add('a', '2', 'D')}, CASE WHEN may AND r = 'a' THEN {add('u', 'x', 'K')} END,
                   CASE WHEN may THEN {add('u', '1 + x', 'R')} END) AS a
      FROM st JOIN g ON g.conv_id IS NOT DISTINCT FROM st.conv_id AND g.i = st.i + 1))
), e AS (
  SELECT conv_id, CAST(best[1:9] AS BIGINT) AS cost, best[10:] AS audit FROM (
    SELECT conv_id, arg_max(least(z, a), i) AS best FROM st GROUP BY conv_id)
), q AS (
  SELECT conv_id, k, l, sum(CASE WHEN l <> 'I' THEN 1 ELSE 0 END) OVER w AS i, sum(CASE WHEN l <> 'D' THEN 1 ELSE 0 END) OVER w AS j
  FROM e, unnest(range(1, len(audit) + 1)) AS b(k), LATERAL (SELECT audit[k] AS l)
  WINDOW w AS (PARTITION BY conv_id ORDER BY k)
), v AS (
  SELECT q.conv_id, k, l, j, g.role, g.text, max(CASE WHEN j = 1 AND l = 'K' AND r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY q.conv_id) AS off
  FROM q LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM q.conv_id AND g.i = q.i WHERE l <> 'D'
), p AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN l = 'K' THEN role WHEN (j - off) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                    || ':' || CASE WHEN l = 'I' THEN '' ELSE text END, chr(10) ORDER BY k)) AS sha
  FROM v GROUP BY conv_id
), c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (dup) AS duplicate, count(*) FILTER (may AND cut) AS truncated,
         count(*) FILTER (i > 1 AND r0 || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM g GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
       coalesce(sha, sha256('')) AS repaired_sha256
FROM e LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM e.conv_id
"""


ORACLE = _oracle()
