import random
import re

from strata.llm import lines as L
from tests.llm.helpers import awkward, docs_of, empty


def near(a, b):
    """Within one insertion, deletion or substitution of a word."""
    if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < L.MIN_WORDS:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(texts):
    seen, out = [], []
    for doc, t in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)):
        n = copies = close = 0
        kept = []
        for no, line in enumerate((t or "").split("\n")):
            w = tuple(x for x in re.split(r"[\x20\x09-\x0D]+", line) if x)
            if not w:
                continue
            n += 1
            if w in seen:
                copies += 1
                continue
            if any(near(w, s) for s in seen):
                close += 1
            else:
                kept.append(no)
            seen.append(w)
        out.append((doc, n, copies, close, kept))
    return out


def check(df, texts):
    got = [(r["doc"], r["n_lines"], r["n_copies"], r["n_near"], r["kept"]) for r in L.dedup_lines(df).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(got, key=key) == sorted(brute(texts), key=key)


def test_against_brute_force(spark):
    rng = random.Random(8)
    base = [[f"w{rng.randint(0, 30)}" for _ in range(rng.randint(1, 14))] for _ in range(25)]
    texts = []
    for _ in range(40):
        rows = []
        for _ in range(rng.randint(0, 7)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(w) + 1)
                edit = rng.randrange(3)
                if edit == 0:
                    w.insert(at, rng.choice("xyz"))
                elif w[at:at + 1]:
                    w[at:at + 1] = [] if edit == 1 else [rng.choice("xyz")]
            rows.append("  ".join(w))
        texts.append("\n".join(rows))
    check(docs_of(spark, texts).repartition(4), list(enumerate(texts)))


def test_a_common_line_and_many_variants_of_one(spark):
    texts = ["one line that all of them share"] * 50
    texts += [f"page {i} of the very same report" for i in range(60)]
    check(docs_of(spark, texts), list(enumerate(texts)))


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = {(r["doc_id"], r["text"]) for r in df.collect()}
    got = L.dedup_lines(df).collect()
    assert len(got) == len(rows)
    by = {(r["doc"], r["same"]): r for r in got}
    assert sum(r["n_copies"] for r in by.values()) == 1            # document 7 repeats document 1
    assert L.dedup_lines(empty(spark)).count() == 0
