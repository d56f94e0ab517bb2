"""Scoring a stream gives the same rows as scoring the table."""

import uuid

from strata.operators import mlp
from strata.operators.model import score
from strata.plans import fixtures as fx
from strata.session import scratch_path
from strata.streaming import scoring
from tests.conftest import SF001


def test_stream_scoring_equals_batch(spark):
    df = fx.emb10(spark, SF001)
    src = scratch_path(spark, f"stream-src-{uuid.uuid4().hex}")
    df.repartition(3).write.parquet(src)
    params = mlp.init_params([64, 8, 10], 3)
    stream = scoring.parquet_stream(spark, src, df.schema)
    out = scratch_path(spark, f"stream-out-{uuid.uuid4().hex}")
    q = scoring.start(scoring.score_stream(stream, params, keep=["vec_id", "label"]), out,
                      f"t-{uuid.uuid4().hex}", trigger_once=True)
    q.awaitTermination(120)
    got = sorted((r.vec_id, r.prediction) for r in spark.read.parquet(out).collect())
    want = sorted((r.vec_id, r.prediction) for r in score(df, params).collect())
    assert got == want
