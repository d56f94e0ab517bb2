import math
from collections import defaultdict

import pytest

from strata.llm import mixing
from tests.llm.helpers import SCHEMA, awkward, docs_of, empty


def test_targets_share_all_words_below_the_cap():
    sizes = {"a": 100, "b": 10, "c": 1000, None: 50, "z": 0}
    got = mixing.targets(sizes)
    assert sum(got.values()) == pytest.approx(1160)
    assert all(got[s] <= 3 * sizes[s] + 1e-9 for s in sizes)
    assert got["z"] == 0 and got["b"] == 30
    free = [s for s in sizes if got[s] < 3 * sizes[s]]
    weight = {"a": 1, "b": 2, "c": 3, "z": 1, None: 2}       # null is last in order
    assert len({round(got[s] / weight[s], 6) for s in free}) == 1


def test_mix_is_systematic_sampling(spark):
    texts = ["w " * (1 + i * 7 % 40) for i in range(3000)]
    docs = docs_of(spark, texts).selectExpr(
        "doc_id", "text", "concat('s', doc_id % 5 * doc_id % 5) source")
    a = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    b = {r["doc_id"]: r["_mix_copies"] for r in mixing.mix(docs.repartition(7)).collect()}
    assert {k: r["_mix_copies"] for k, r in a.items()} == b           # reruns agree
    taken, target = defaultdict(int), {}
    for r in a.values():
        rate = r["_mix_target"] / r["_mix_source_size"]
        assert math.floor(rate) <= r["_mix_copies"] <= math.ceil(rate) <= 3
        taken[r["source"]] += r["_mix_copies"] * r["_mix_size"]
        target[r["source"]] = r["_mix_target"]
    for s in taken:
        assert taken[s] == pytest.approx(target[s], rel=0.02)


def test_mix_survives_awkward_rows(spark):
    df = awkward(spark)
    got = mixing.mix(df).collect()
    assert len(got) == df.count()
    assert {r["source"] for r in got} == {"a", "b", "c", None}
    assert all(r["_mix_size"] == 0 for r in got if not (r["text"] or "").strip())
    assert mixing.mixed_docs(df).columns == df.columns
    assert mixing.mix(empty(spark)).count() == 0


def test_null_and_repeated_ids_are_mixed_alike_at_every_partitioning(spark):
    rows = [(None if i % 3 == 0 else i // 4, f"word{i % 50} " * (1 + i % 3), "en", f"s{i % 5 % 3}", i % 7) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    a, b = (sorted(map(tuple, mixing.mixed_docs(df.repartition(k)).collect()), key=str) for k in (3, 5))
    assert a == b and len(a) > 300


def test_rows_without_id_spread_over_the_slots(spark):
    df = spark.createDataFrame([(None, f"text{i}", "en", "s", 1) for i in range(2000)], SCHEMA)
    got = mixing.mix(df)
    assert got.count() == 2000 and "_mix_slot" not in got.columns
    key = "md5(concat(':', md5(text)))"
    assert df.selectExpr(f"substring({key}, 1, 3) k").groupBy("k").count().agg({"count": "max"}).first()[0] < 10
