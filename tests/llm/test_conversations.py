import hashlib
import itertools
import random
import re
import zlib

import pytest

from strata.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, seg long, audit string"
OK = re.compile(r"(s?(ua)+)?\Z")


def cheapest(rows):
    """Lightest (cost, audit, rows left) by trying all edits, Inserts included.
    Rows: role, text, fault."""
    states = {"": (0, "", [])}

    def grow(states):
        for _ in range(2):
            for i, (c, a, left) in list(states.items()):
                for role in ("user", "assistant"):
                    keep(states, i + role[0], (c + 5, a + "I", [*left, (role, "")]))
        return states

    def keep(states, initials, new):
        # Only what the pattern allows; equal tails behave alike.
        if not re.match(r"(s?(ua)*u?)\Z", initials):
            return
        short = initials if initials in ("", "s") else initials[-1]
        if short not in states or new[:2] < states[short][:2]:
            states[short] = new

    states = grow(states)
    for role, text, fault in rows:
        after = {}
        for i, (c, a, left) in states.items():
            full = {"": "", "s": "s", "u": "u", "a": "ua"}[i]
            keep(after, i and full, (c + 2, a + "D", left))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if role:
                    keep(after, full + role[0], (c + extra, a + "K", [*left, (role, text)]))
                for r in ("user", "assistant"):
                    keep(after, full + r[0], (c + 1 + extra, a + "R", [*left, (r, text)]))
        states = grow(after)
    return min((v for k, v in states.items() if k in ("", "a")), key=lambda v: v[:2])


def all_edits(rows, most):
    """The same by listing every string of edits (tiny inputs only)."""
    best = None
    options = [[("D", 2, None)] + ([] if f in ("blank", "duplicate") else
               [("K", 5 * (f == "truncated"), role)] + [("R", 1 + 5 * (f == "truncated"), x) for x in ("user", "assistant")])
               for role, _, f in rows]
    inserts = [[p for k in range(most + 1) for p in itertools.product(("user", "assistant"), repeat=k)]] * (len(rows) + 1)
    for edit in itertools.product(*options):
        for ins in itertools.product(*inserts):
            cost = sum(e[1] for e in edit) + 5 * sum(map(len, ins))
            if best and cost > best[0]:
                continue
            audit = "".join("I" * len(p) + e[0] for p, e in zip(ins, edit)) + "I" * len(ins[-1])
            roles = [r for p, e in zip(ins, edit) for r in (*p, *([e[2]] if e[2] is not None else []))] + list(ins[-1])
            if OK.match("".join(r[:1] or "-" for r in roles)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit)
    return best


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        t = text.rstrip(" \t\n\x0b\x0c\r")
        out.append((role, text, "blank" if not t else "duplicate" if (role, text) in seen
                    else "truncated" if t[-1] not in ".!?" else ""))
        seen.add((role, text))
    return out


def brute(rows):
    """conv_id -> the whole result, from undamaged (conv_id, turn, role, text)."""
    sp = lambda x: " " if x is None else str(x)
    convs = {r[0]: [] for r in rows}
    for c, turn, role, text in rows:
        role, text, w = sp(role), sp(text), zlib.crc32(f"{sp(c)}:{sp(turn)}".encode()) % 20
        if w == 0:
            continue
        text = "" if w == 1 else re.sub("[.!?]", "", text) if w == 2 else text
        convs[c] += [(turn, "user" if w == 4 else role, text)] * (2 if w == 3 else 1)
    out = {}
    for c, had in convs.items():
        had.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        f = faults([r[1:] for r in had])
        turns = {r[0] for r in had} - {None}
        initials = [r[1][:1] for r in had]
        cost, audit, left = cheapest(f)
        out[c] = {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                  **{k: sum(x[2] == k for x in f) for k in ("blank", "duplicate", "truncated")},
                  "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                  "cost": cost, "audit": audit,
                  "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)


def check(spark, rows, parts=5):
    got = C.digest(frame(spark, rows).repartition(parts)).collect()
    want = brute(rows)
    assert len(got) == len(want)
    for r in got:
        assert {k: r[k] for k in want[r["conv_id"]]} == want[r["conv_id"]], r["conv_id"]


def random_rows(rng, convs, most, texts=6):
    out = []
    for c in range(convs):
        for t in range(rng.randint(1, most)):
            out.append((c, t, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "sam"]),
                        rng.choice(["", " \n", *(f"text {k}{rng.choice('.!? x')}" for k in range(texts))])))
    return out


def test_agenda_against_all_edits():
    rng = random.Random(1)
    for _ in range(150):
        rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), "x", rng.choice(["", "", "truncated", "blank"]))
                for _ in range(rng.randint(0, 3))]
        steps = [(r[:1], f not in ("blank", "duplicate"), f == "truncated", 1) for r, _, f in rows]
        found = C.edits(steps, "0")
        assert min(found[q] for q in C.ENDS if q in found) == all_edits(rows, 2 if len(rows) < 3 else 1) == cheapest(rows)[:2]


def test_segments_combine_to_the_whole():
    rng = random.Random(2)
    for _ in range(100):
        steps = [(rng.choice("suaut"), rng.random() < 0.7, rng.random() < 0.2, rng.choice([1, 1, 2, 3])) for _ in range(rng.randint(1, 30))]
        whole = C.edits(steps, "0")
        parts = [steps[i:i + 4] for i in range(0, len(steps), 4)]
        got = C.combine([{(p, q): w for p in C.STATES for q, w in C.edits(x, p).items()} for x in parts])
        assert got == min(whole[q] for q in C.ENDS if q in whole)


def test_against_brute_force(spark):
    check(spark, random_rows(random.Random(3), 120, 9))


@pytest.mark.parametrize("size", [1, 3])
def test_long_conversations_in_many_segments(spark, monkeypatch, size):
    monkeypatch.setattr(C, "SEGMENT", size)
    rows = random_rows(random.Random(4), 6, 60) + [(99, t, "user", "same words.") for t in range(150)]
    check(spark, rows, 7)


def test_awkward_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (1, None, "user", None), (1, None, "assistant", "b."), (1, 5, None, "c"),
            (2, 0, "user", "x. \n"), (2, 0, "user", "x. \n"), (2, 0, "assistant", "y?"), (3, 0, "", ""),
            (4, 0, "system", "s."), (4, 1, "user", "q " * 200_000 + "."), (4, 9, "assistant", "Ünï \U0001f600!"),
            (5, -3, "system", "only."), (6, 2, "\U0001f600", "z.\x0b\x0c")]
    check(spark, rows, 3)
    assert C.digest(frame(spark, [])).collect() == []
