import bisect
import hashlib
import re
import time

from pyspark.sql import functions as F

from strata.llm import spotsigs as S
from tests.llm.helpers import awkward, docs_of, empty


def brute(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    out, content = set(), [i for i, x in enumerate(w) if x not in S.ANCHORS]
    for i, a in enumerate(w):
        at = bisect.bisect_right(content, i)
        rest = [w[k] for k in content[at:at + S.CHAIN]]
        if a in S.ANCHORS and rest:
            out.add((a, *rest))
        if len(w) - i > S.STRETCH and not any(x in S.ANCHORS for x in w[i:i + S.STRETCH + 1]):
            out.add(tuple(w[i:i + S.CHAIN + 1]))
    if not out:
        out = {tuple(w[i:i + S.CHAIN + 1]) for i in range(len(w))} or ({text} if text else set())
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


TEXTS = ["the cat of the house and a dog", "The cat, of the HOUSE and a dog!", "junk1 junk2 junk3", "", None,
         "!!!", "a b c d e f g h i j k l m n o p", "the cat of the house and a bird", "la maison de l'été est belle",
         " ".join(f"name{i}" for i in range(30)), "the"]


def test_signatures_against_brute_force(spark):
    rows = S.with_signatures(docs_of(spark, TEXTS), "text", "s").collect()
    sets = [brute(r["text"]) for r in rows]
    for r, s in zip(rows, sets):
        assert len(r["s"]) == len(s)
    for a, x in zip(rows, sets):
        for b, y in zip(rows, sets):
            both = len(set(a["s"]) & set(b["s"]))
            assert both == len(x & y)
    assert rows[0]["s"] == rows[1]["s"]


def check_edits(df):
    rows = [(r["doc_id"], r["text"] or "") for r in df.collect()]
    got = S.edited_fingerprints(df).collect()
    tie = {t: h for t, h in df.select(F.coalesce("text", F.lit("")).alias("t"))
           .select("t", F.xxhash64("t")).collect()}
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), tie[r[1]]))
    want = []
    for i, (d, t) in enumerate(rows):
        n, nxt = len(t) // 3, rows[(i + 1) % len(rows)][1]
        e = t[:len(t) - n] + nxt[:n]
        want.append((d is None, d or 0, len(t), hashlib.sha256(e.encode()).hexdigest(),
                     round(jaccard(brute(t), brute(e)), 9), round(jaccard(brute(t), brute(nxt)), 9)))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"],
                   round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got) == sorted(want)


def test_edited_texts_and_next_documents(spark, monkeypatch):
    check_edits(docs_of(spark, TEXTS))
    monkeypatch.setattr(S, "ROWS_PER_BUCKET", 2)
    monkeypatch.setattr(S, "COARSE", 2)
    check_edits(docs_of(spark, TEXTS * 3).repartition(5))
    check_edits(docs_of(spark, ["only one of the texts here"]))


def test_awkward_rows(spark):
    check_edits(awkward(spark))
    assert S.edited_fingerprints(empty(spark)).count() == 0


def test_search_finds_every_near_set(spark):
    base = [f"the w{i} of a v{i} and the u{i} in x{i}" for i in range(40)]
    texts = [" ".join(base[:k]) for k in (5, 6, 20, 21, 22, 39, 40)] + base[:5] + base[:2]
    df = S.with_signatures(docs_of(spark, texts), "text", "signatures").selectExpr("doc_id id", "signatures")
    sets = [brute(t) for t in texts]
    want = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if jaccard(a, b) >= 0.8}
    got = S.search(df, df.selectExpr("id query", "signatures")).collect()
    assert {(r["query"], r["id"]) for r in got} == want
    assert all(abs(r["likeness"] - jaccard(sets[r["query"]], sets[r["id"]])) < 1e-9 for r in got)


def test_no_python_in_the_plan(spark, capsys):
    S.edited_fingerprints(docs_of(spark, TEXTS)).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def test_texts_of_stop_words_take_linear_time(spark):
    texts = ["la " * 200_000, "la " * 200_000 + "mot suite", "la mot " * 200_000, "the of " * 3 + "cat dog"]
    S.with_signatures(docs_of(spark, ["la la mot"]), "text", "s").collect()
    began = time.time()
    rows = S.with_signatures(docs_of(spark, texts), "text", "s").orderBy("doc_id").collect()
    assert time.time() - began < 30
    assert [len(r["s"]) for r in rows] == [len(brute(t)) for t in texts]
