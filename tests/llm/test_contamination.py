import random
import re

import pytest

from strata.llm import contamination as C
from strata.llm.queries import new_folder
from tests.llm.helpers import awkward, docs_of, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        x = words(t)
        n = min(13, len(x))
        for i in range(max(1, len(x) - 12) if x else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == x[i:i + n]:
                    hit.update(range(p, p + n))
                    if item is not None:
                        found.add(str(item))
    return len(w), len(hit), sorted(found)


def check(spark, docs, items):
    path = new_folder(spark, "postings")
    C.write_index(docs, path)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r["n_words"], r["n_hit"], r["items"]) for r in C.contamination(spark, path, bench).collect())
    assert got == sorted(brute(r["text"], items) for r in docs.collect())
    return path, bench


def test_against_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(12)] + ["é", "zü9"]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 120))) for _ in range(40)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n)).upper())
             for i, n in enumerate([0, 1, 2, 3, 12, 13, 14, 20])]
    items += [(20, texts[3][10:150]), (21, texts[5] + " tail"), (None, texts[7]), (22, None), (20, texts[9][:90])]
    texts += [texts[5] + ". " + texts[3], items[7][1].lower().replace(" ", "-")]
    check(spark, docs_of(spark, texts), items)


def test_awkward_rows_and_empty_tables(spark):
    df = awkward(spark)
    path, bench = check(spark, df, [(1, "cat sat on"), (2, "wide characters"), (3, "")])
    assert C.contamination(spark, path, bench.where("false")).where("n_hit > 0").count() == 0
    none = new_folder(spark, "postings")
    C.write_index(empty(spark), none)
    assert C.contamination(spark, none, bench).count() == 0


def test_benchmark_in_parts_gives_the_same(spark, monkeypatch):
    docs = docs_of(spark, ["a b c d e f", "x a b c y c d e", "nothing"])
    items = [(i, t) for i, t in enumerate(["a b c", "c d e", "b c y", "q"])]
    monkeypatch.setattr(C, "PART_BYTES", 4)
    check(spark, docs, items)


def test_proximity_matches(spark):
    path = new_folder(spark, "postings")
    C.write_index(docs_of(spark, ["one two big three four", "one two three four", "four three two one"]), path)
    bench = spark.createDataFrame([(5, "one two three four")], "item_id long, text string")
    exact = C.matches(spark, path, bench).collect()
    near = C.matches(spark, path, bench, slack=1).collect()
    assert [(r["doc_id"], r["start"], r["length"]) for r in exact] == [(1, 0, 4)]
    assert {r["doc_id"] for r in near} == {0, 1}


@pytest.mark.parametrize("block", [60, 4 << 20])
def test_proximity_against_brute_force_at_two_block_sizes(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK_BYTES", block)
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(6)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 5)))) for i in range(25)]
    path = new_folder(spark, "postings")
    C.write_index(docs_of(spark, texts).coalesce(2), path)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for slack in (1, 2):
        want = set()
        for d, t in enumerate(texts):
            w = t.split()
            for i, x in items:
                x = x.split()
                for p in range(len(w)):
                    if w[p] == x[0] and all(x[j] in w[max(0, p + j - slack):p + j + slack + 1] for j in range(len(x))):
                        want.add((d, str(i), p, len(x)))
        got = [(r["doc_id"], r["item"], r["start"], r["length"]) for r in C.matches(spark, path, bench, slack=slack).collect()]
        assert len(got) == len(set(got)) and set(got) == want
