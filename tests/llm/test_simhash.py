import random
import re

import numpy as np
import xxhash

from strata.llm import simhash as S
from tests.llm.helpers import awkward, docs_of, empty


def brute_fp(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    runs = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(values, bits):
    up = list(range(len(values)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= bits:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def fps_of(spark, values):
    return spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")


def check_links(spark, values, bits, **kw):
    values = sorted(set(values))
    comp = {r["node"]: r["root"] for r in S.components(S.links(fps_of(spark, values), bits, **kw)).collect()}
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    got = {}
    for v, s in zip(values, signed):
        got.setdefault(comp.get(s, s), set()).add(v)
    want = {}
    for v, r in zip(values, roots(values, bits)):
        want.setdefault(r, set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_fingerprints(spark):
    df = awkward(spark)
    for r in S.fingerprints(df.select("doc_id", "text").withColumn("t", df.text), "text").collect():
        assert r["fp"] & (2 ** 64 - 1) == brute_fp(r["t"])


def test_links_near_clusters_chains_and_heavy_keys(spark):
    rng = random.Random(2)
    values = [rng.getrandbits(64) for _ in range(150)]
    for v in values[:30]:
        for k in (1, 2, 3, 4):
            for b in rng.sample(range(64), k):
                v ^= 1 << b
            values.append(v)
    hot = rng.getrandbits(64)
    values += [hot ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 5))) for _ in range(200)]
    check_links(spark, values, 2)
    check_links(spark, values, 2, heavy=8)          # the same when keys are split
    check_links(spark, values[:200], 3, heavy=8)


def test_groups_cover_all_bits_and_thresholds_add_up():
    rng = np.random.default_rng(0)
    both = rng.random((64, 64))
    groups = S.correlated_groups(10, both + both.T, 3)
    assert sorted(sum(groups, [])) == list(range(64))
    ts, cost = S.thresholds([[5.0, 9, 50], [1.0, 100, 300], [7.0, 8, 9]], 0)
    assert sum(ts) == 0
    assert cost == min(sum(c[t] if t >= 0 else 0 for c, t in zip([[5, 9, 50], [1, 100, 300], [7, 8, 9]], x))
                       for x in np.ndindex(4, 4, 4) for x in [tuple(i - 1 for i in x)] if sum(x) == 0)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in S.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[1000 + i] == 1000 for i in range(1, 300))


def test_documents(spark):
    base = " ".join(f"w{i * i % 331}" for i in range(300))
    texts = [base, base.upper(), base + " tail", "other text of its own", "", None, " ", base + " end"]
    texts += [f"unrelated number {i} of {i * 7} kinds {i * 31}" for i in range(20)]
    got = {r["doc_id"]: r for r in S.near_duplicates(docs_of(spark, texts)).collect()}
    want = roots([brute_fp(t) for t in texts], 2)
    assert [got[i]["component_id"] for i in range(len(texts))] == want
    assert got[5]["component_id"] == got[6]["component_id"] == 4      # fingerprint zero links


def test_awkward_rows(spark):
    df = awkward(spark)
    got = S.near_duplicates(df).collect()
    assert len(got) == df.count()
    of = {}
    for r in got:
        of.setdefault(r["fp"], set()).add(r["component_id"])
    assert all(len(v) == 1 for v in of.values())
    assert of[0] == {2}
    assert S.near_duplicates(empty(spark)).count() == 0
