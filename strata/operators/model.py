"""Parameters as a table, batch scoring, per-row loss.

Scoring runs NumPy on Arrow batches (``mapInArrow``): each task streams
its partition, the weights travel once per executor as a broadcast whose
size is the model's, checked against ``MAX_MODEL_BYTES``.  No rows are
collected and nothing is replicated.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.hashing import uniform_of
from strata.functions.vectors import argmax, cross_entropy
from strata.operators import mlp

MAX_MODEL_BYTES = 512 * 1024 * 1024  # a broadcast model above this is refused


def check_model_size(layers: Sequence[int], copies: int = 1) -> int:
    size = mlp.n_params(layers) * 8 * copies
    if size > MAX_MODEL_BYTES:
        raise ValueError(f"model of {size} bytes is above the broadcast limit")
    return size


def init_params_df(spark: SparkSession, layers: Sequence[int], seed: object,
                   trial_id: int = 0) -> DataFrame:
    """F1 as a table ``(trial_id, layer, i, j, w)``; bias rows have j = -1."""
    parts = []
    n = len(layers) - 1
    for lay in range(n):
        fi, fo = layers[lay], layers[lay + 1]
        bound = mlp.layer_bound(lay, n, fi, fo)
        ids = spark.range(fi * fo)
        i = (F.col("id") / fi).cast("long").cast("int")
        j = (F.col("id") % fi).cast("int")
        u = uniform_of(F.concat(F.lit(f"{seed}:{lay}:"), i.cast("string"), F.lit(":"),
                                j.cast("string")))
        parts.append(ids.select(F.lit(lay).alias("layer"), i.alias("i"), j.alias("j"),
                                (F.lit(bound) * (F.lit(2.0) * u - F.lit(1.0))).alias("w")))
        parts.append(spark.range(fo).select(F.lit(lay).alias("layer"),
                                            F.col("id").cast("int").alias("i"),
                                            F.lit(-1).alias("j"), F.lit(0.0).alias("w")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(trial_id).alias("trial_id"), "layer", "i", "j", "w")


def params_rows(params: mlp.Params, layers: Sequence[int]):
    lay, ii, jj = mlp.param_index(layers)
    vec = mlp.flatten(params)
    return lay, ii, jj, vec


def params_to_df(spark: SparkSession, params: mlp.Params, layers: Sequence[int],
                 trial_id: int = 0, epoch: int = 0) -> DataFrame:
    """Model -> ``(trial_id, epoch, layer, i, j, w)`` table (A4 form)."""
    lay, ii, jj, vec = params_rows(params, layers)
    k = len(vec)
    return spark.createDataFrame(pa.table({
        "trial_id": np.full(k, trial_id, dtype=np.int32),
        "epoch": np.full(k, epoch, dtype=np.int32),
        "layer": lay.astype(np.int32), "i": ii.astype(np.int32), "j": jj.astype(np.int32),
        "w": vec}))


def params_from_df(df: DataFrame, layers: Sequence[int], value_col: str = "w") -> mlp.Params:
    """Table -> model.  Collects exactly ``n_params(layers)`` numbers (the
    model, a checked size); raises on a missing or extra entry (strict load)."""
    check_model_size(layers)
    rows = df.select("layer", "i", "j", value_col).toArrow()
    n = mlp.n_params(layers)
    if rows.num_rows != n:
        raise ValueError(f"expected {n} parameters, got {rows.num_rows}")
    pos = mlp.flat_positions(layers, rows.column("layer").to_numpy(),
                             rows.column("i").to_numpy(), rows.column("j").to_numpy())
    if (pos < 0).any():
        raise ValueError("parameter outside the layer shapes")
    seen = np.zeros(n, dtype=np.int64)
    np.add.at(seen, pos, 1)
    if (seen != 1).any():
        raise ValueError("missing or repeated parameters")
    vec = np.empty(n)
    vec[pos] = rows.column(value_col).to_numpy()
    return mlp.unflatten(vec, layers)


def features_matrix(col: pa.Array, n: int) -> np.ndarray:
    """Dense (n, d) float64 matrix from an Arrow list column (fixed width)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if n == 0:
        return flat.reshape(0, 0)
    if len(flat) % n:
        raise ValueError("feature vectors differ in length")
    return flat.reshape(n, len(flat) // n)


def list_column(mat: np.ndarray) -> pa.Array:
    n, k = mat.shape
    offsets = pa.array(np.arange(0, n * k + 1, k, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(mat.ravel(), type=pa.float64()))


def score(df: DataFrame, params: mlp.Params, features: str = "features",
          keep: Sequence[str] | None = None) -> DataFrame:
    """add ``logits array<double>`` and ``prediction int`` (argmax, first
    on ties).  ``keep`` are the columns carried through (default: all but the
    features); only they and the features cross into Python."""
    keep = [c for c in df.columns if c != features] if keep is None else list(keep)
    layers = [params[0][0].shape[1]] + [w.shape[0] for w, _ in params]
    check_model_size(layers)
    sc = df.sparkSession.sparkContext
    bc = sc.broadcast((layers, mlp.flatten(params)))
    in_schema = df.select(*keep).schema
    out_schema = T.StructType(list(in_schema.fields) + [
        T.StructField("logits", T.ArrayType(T.DoubleType(), False), False),
        T.StructField("prediction", T.IntegerType(), False)])

    def run(batches):
        lays, vec = bc.value
        ps = mlp.unflatten(vec, lays)
        for b in batches:
            n = b.num_rows
            x = features_matrix(b.column(features), n)
            logits = mlp.forward(ps, x) if n else np.zeros((0, lays[-1]))
            pred = logits.argmax(axis=1).astype(np.int32) if n else np.zeros(0, np.int32)
            cols = [b.column(c) for c in keep] + [list_column(logits), pa.array(pred)]
            yield pa.RecordBatch.from_arrays(cols, names=keep + ["logits", "prediction"])

    return df.select(*keep, features).mapInArrow(run, out_schema)


def with_loss(scored: DataFrame, label: str = "label", loss_col: str = "loss") -> DataFrame:
    """per-row softmax cross-entropy from ``logits`` (JVM expression)."""
    return scored.withColumn(loss_col, cross_entropy(F.col("logits"), F.col(label)))


def with_hit(scored: DataFrame, label: str = "label") -> DataFrame:
    return scored.withColumn("hit", (F.col("prediction") == F.col(label)).cast("double"))


#: Weights that become literals of a plan, at most; larger models go through ``score``.
MAX_SQL_WEIGHTS = 50_000


def sql_forward(df: DataFrame, params: mlp.Params, features: str = "features") -> DataFrame:
    """F2-F4 written as Catalyst expressions (small models only): the same
    logits as ``score`` without leaving the JVM.  Each layer is a column of its
    own, so the plan grows with the sum of the layers, not with their product."""
    from strata.functions.vectors import dense_layer, relu
    if sum(w.size for w, _ in params) > MAX_SQL_WEIGHTS:
        raise ValueError(f"more than {MAX_SQL_WEIGHTS} weights: use score()")
    out, h, layers = df, F.col(features), []
    for k, (w, b) in enumerate(params):
        h = dense_layer(h, w.tolist(), b.tolist())
        if k < len(params) - 1:
            layers.append(f"__h{k}")
            out = out.withColumn(layers[-1], relu(h))
            h = F.col(layers[-1])
    return (out.withColumn("logits", h).withColumn("prediction", argmax(F.col("logits")))
            .drop(*layers))
