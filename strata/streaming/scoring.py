"""Scoring a stream with a trained model.

Scaling (C2), encoding (C3/C4) and scoring (F12) are row-local, so the
batch operators apply to a streaming DataFrame unchanged: this module only
wires source and sink.  The sink's checkpoint lives in the session's shared
checkpoint folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.operators import mlp
from strata.operators.features import MinMaxModel
from strata.operators.model import score, with_loss
from strata.session import scratch_path


def parquet_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """A folder of Parquet files as a stream (new files are new rows)."""
    return (spark.readStream.schema(schema)
            .options(**({"maxFilesPerTrigger": max_files} if max_files else {}))
            .parquet(path))


def score_stream(stream: DataFrame, params: mlp.Params, features: str = "features",
                 keep: Sequence[str] | None = None, scaler: MinMaxModel | None = None,
                 label: str | None = None) -> DataFrame:
    df = scaler.apply(stream) if scaler is not None else stream
    out = score(df, params, features, keep)
    return with_loss(out, label) if label else out


def start(scored: DataFrame, sink_path: str, name: str, fmt: str = "parquet",
          trigger_once: bool = False) -> StreamingQuery:
    """Append scored rows to ``sink_path``; progress is checkpointed under
    ``<spark.checkpoint.dir>/streams/<name>``."""
    w = (scored.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", scratch_path(scored.sparkSession, "streams", name)))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start(sink_path)
