import random

import numpy as np
import pyarrow as pa

from strata.llm import quality as Q
from strata.llm import toxicity as X
from strata.llm.common import labelled_sample, remainder, words_of, utf8, ALNUM
from strata.llm.queries import op4_quality, op7_toxicity
from tests.llm.helpers import awkward, docs_of, empty, write_tables
from tests.conftest import SF01


def held_out_rate(spark, fn, label):
    got = fn(spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id")
    rows = got.where("held_out").collect()
    return np.mean([r["predicted"] == r[label] for r in rows]), rows


def test_quality_on_held_out_rows(spark):
    rate, rows = held_out_rate(spark, op4_quality, "quality")
    assert rate >= 0.97
    assert all((r["score"] >= 0.7) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in rows)


def test_toxicity_on_held_out_rows(spark):
    rate, rows = held_out_rate(spark, op7_toxicity, "toxic")
    assert rate >= 0.93
    assert not [r for r in rows if r["predicted"] and not r["toxic"]]


def test_toxicity_learns_words_pairs_and_skips():
    rng = random.Random(1)
    texts, y = [], []
    for i in range(600):
        w = [f"w{rng.randint(0, 80)}" for _ in range(40)]
        kind = i % 6
        if kind == 0:
            w[5] = "awful"
        elif kind == 1:
            w[5:7] = ["you", "fool"]
        elif kind == 2:
            w[5:8] = ["shut", w[9], "mouth"]
        elif kind == 3:
            w[5], w[20] = "fool", "you"                 # apart: harmless
        texts.append(" ".join(w))
        y.append(int(kind < 3))
    ids = [np.unique(X.features(pa.array([t], pa.large_string()))[0]) for t in texts]
    m = X.ftrl(ids[:500], np.array(y[:500], float), l1=3.0)
    dense = m.dense()
    got = [int(dense[i].sum() + m.bias >= 0) for i in ids[500:]]
    assert np.mean(np.array(got) == y[500:]) >= 0.97
    assert len(m.index) < 1000                          # sparse


def test_bradley_terry_orders_pairs_and_cuts_at_the_quantile():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, len(Q.NAMES)))
    y = (x[:, 0] - x[:, 3] > -0.8).astype(int)
    m = Q.fit(x, y)
    s = m.score(x)
    assert ((s >= Q.KEEP) == (y == 1)).mean() > 0.95
    assert abs((s < Q.KEEP).mean() - (y == 0).mean()) < 0.01


def test_models_without_labels_and_awkward_rows(spark, tmp_path):
    df = awkward(spark)
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    d = write_tables(spark, tmp_path, documents=df, labels=labels)
    for fn, base in ((op4_quality, 0.7), (op7_toxicity, 0.5)):
        rows = fn(spark, d).collect()
        assert len(rows) == df.count()
        assert all(abs(r["score"] - base) < 1e-9 for r in rows)


def test_scores_of_awkward_rows_are_stable(spark):
    df = awkward(spark).withColumnRenamed("h", "score")
    x = np.random.default_rng(1).normal(size=(50, len(Q.NAMES)))
    m = Q.fit(x, (x[:, 1] > 0).astype(int))
    rows = Q.score(df, m).collect()
    assert len(rows) == df.count() and all(0 <= r["score"] <= 1 for r in rows)
    by = {}
    for r, t in zip(Q.score(df.withColumn("t", df.text), m, "t").collect(), df.collect()):
        by.setdefault(r["text"], set()).add(r["score"])
    assert all(len(v) == 1 for v in by.values())        # equal texts score alike
    assert Q.score(empty(spark), m).count() == 0
    assert X.score(empty(spark), X.Model(0.0, np.array([], int), np.array([]))).count() == 0


def test_the_sample_is_bounded_and_the_same_at_every_partitioning(spark):
    docs = docs_of(spark, [f"text {i}" for i in range(200)])
    docs = docs.unionByName(docs)                       # repeated rows count once
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] * 2, "doc_id long, y0 int")
    keep = remainder("doc_id", 4) != 2
    a = labelled_sample(docs, labels, "y0", keep, 50).collect()
    b = labelled_sample(docs.repartition(9), labels.repartition(3), "y0", keep, 50).collect()
    assert len(a) == 50 and sorted(a) == sorted(b)
    assert labelled_sample(empty(spark), labels, "y0", keep, 50).count() == 0


def test_word_hashes():
    texts = ["The cat", "the CAT the", None, "", "a-b é", "x" * 3000 + " cat"]
    h, b, e, row = words_of(*utf8(pa.array(texts)), ALNUM, chunk=50)
    raw = utf8(pa.array(texts))[0].tobytes().lower()
    words = [raw[i:j] for i, j in zip(b, e)]
    assert row.tolist() == [0, 0, 1, 1, 1, 4, 4, 4, 5, 5]
    assert len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))
