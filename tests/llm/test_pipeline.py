import math
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline as P
from strata.llm import mixing, simhash
from strata.llm.queries import QUERIES, tokenizer_path
from strata.llm.dac import encoder
from tests.conftest import SF001
from tests.llm.helpers import awkward, empty, write_tables
from tests.llm.test_contamination import brute as hits
from tests.llm.test_simhash import brute_fp, roots

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def written(spark, df, folder):
    df.write.parquet(str(folder))
    return spark.read.parquet(str(folder))


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    stages = dict(P.STAGES)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    step = written(spark, stages["quality"](spark, docs, SF001), tmp_path / "1")
    assert step.columns == COLUMNS
    left = {r["doc_id"] for r in step.collect()}
    assert np.mean([(d in left) == (q == 1) for d, q in labels.items()]) > 0.95

    rows = sorted(step.collect(), key=lambda r: r["doc_id"])
    up = roots([brute_fp(r["text"]) for r in rows], simhash.MAX_BITS)
    step = written(spark, stages["simhash"](spark, step, SF001), tmp_path / "2")
    assert {r["doc_id"] for r in step.collect()} == {rows[i]["doc_id"] for i in set(up)}
    assert step.columns == COLUMNS

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in step.collect() for n, k, _ in [hits(r["text"], items)] if not k or 20 * k < n}
    step = written(spark, stages["decontamination"](spark, step, SF001), tmp_path / "3")
    assert {r["doc_id"] for r in step.collect()} == clean and step.columns == COLUMNS

    size = {r["doc_id"]: len((r["text"] or "").split()) for r in step.collect()}
    source = {r["doc_id"]: r["source"] for r in step.collect()}
    total = Counter()
    for d, n in size.items():
        total[source[d]] += n
    target = mixing.targets(dict(total))
    step = written(spark, stages["mixing"](spark, step, SF001), tmp_path / "4")
    copies = Counter(r["doc_id"] for r in step.collect())
    for d in size:
        rate = target[source[d]] / total[source[d]]
        assert math.floor(rate) <= copies[d] <= math.ceil(rate)
    assert step.columns == COLUMNS

    tok = encoder(tokenizer_path()).tokenizer
    want = sorted((r["doc_id"], zlib.crc32(np.array(tok.encode(r["text"], add_special_tokens=False).ids + [0],
                                                    "<u4").tobytes())) for r in step.collect())
    last = stages["tokens"](spark, step, SF001).collect()
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in last) == want


def test_awkward_and_empty_documents(spark, tmp_path):
    sf = write_tables(spark, tmp_path / "sf", documents=awkward(spark),
                      labels=spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"),
                      benchmark=spark.createDataFrame([(1, "cat sat on"), (None, None)], "item_id long, text string"))
    docs = awkward(spark)
    for k, (_, stage) in enumerate(P.STAGES):
        assert stage(spark, written(spark, empty(spark), tmp_path / f"e{k}"), sf).count() == 0
        out = written(spark, stage(spark, docs, sf), tmp_path / f"a{k}")
        if k < 4:
            assert out.columns == docs.columns
        docs = out
    assert P.run(spark, sf).count() == docs.count() > 0


def test_every_query_survives_awkward_tables(spark, tmp_path):
    docs = awkward(spark)
    some = dict(labels=spark.createDataFrame([(1, 1, 0), (8, 0, 1)], "doc_id long, quality int, toxic int"),
                benchmark=spark.createDataFrame([(1, "cat sat on")], "item_id long, text string"))
    talks = spark.createDataFrame(
        [(1, 0, "user", "a."), (1, None, None, None), (None, 3, "assistant", ""), (None, 3, "assistant", ""), (2, 5, "system", "b")],
        "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS seg", "'x' AS audit")
    vectors = spark.createDataFrame(
        [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [2.0, -1.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 0.0]), (6, [1.0, 3.0])],
        "vec_id long, embedding array<float>").selectExpr("*", "1 AS key", "'x' AS n")
    some["conversations"], some["embeddings"] = talks, vectors
    bare = {**some, "conversations": talks.where("false"), "embeddings": vectors.where("false")}
    full = write_tables(spark, tmp_path / "full", documents=docs, **some)
    none = write_tables(spark, tmp_path / "none", documents=empty(spark), **bare)
    assert sorted(QUERIES) == sorted(f"op{n}_{x}" for n, x in (
        (1, "spotsigs"), (2, "wordpiece_counts"), (3, "dac_tokens"), (4, "quality"), (5, "secrets"),
        (6, "line_dedup"), (7, "toxicity"), (8, "decontamination"), (9, "mixing"), (10, "simhash"),
        (11, "conversation_repair"), (12, "substring_dedup"), (13, "whitening")))
    for name, fn in QUERIES.items():
        want = docs.count() - (name == "op6_line_dedup")      # rows of one id and text
        want = {"op11_conversation_repair": 3, "op13_whitening": 8}.get(name, want)   # ids; 4 rows of 2 components
        assert fn(spark, full).count() == want, name
        assert fn(spark, none).count() == 0, name
