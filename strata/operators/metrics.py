"""Evaluation figures as DataFrame aggregations.

All of them are global or low-cardinality group-bys, so partial aggregation
runs map-side and only a few rows are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_loss(scored: DataFrame, loss_col: str = "loss") -> DataFrame:
    """G1: mean loss over all rows."""
    return scored.agg(F.avg(loss_col).alias("loss"))


def accuracy(scored: DataFrame, label: str = "label") -> DataFrame:
    """Mean of (prediction == label)."""
    return scored.agg(
        F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"))


def batch_mean_loss(scored: DataFrame, batch_col: str = "batch_id",
                    loss_col: str = "loss", by: Sequence[str] = ()) -> DataFrame:
    """Mean over batches of the batch mean loss (a short last batch
    weighs as much as a full one).  Two aggregations; the first has one row
    per batch."""
    per_batch = scored.groupBy(*by, batch_col).agg(F.avg(loss_col).alias("__bl"))
    return per_batch.groupBy(*by).agg(F.avg("__bl").alias("loss"))


def shard_accuracy(scored: DataFrame, n_rows: int, world_size: int,
                   label: str = "label", shard_col: str = "shard") -> DataFrame:
    """Per shard, correct predictions / (n_rows // world_size), the
    per-worker figure (padding rows count)."""
    size = n_rows // world_size
    if size == 0:
        raise ValueError("fewer rows than shards")
    hit = (F.col("prediction") == F.col(label)).cast("long")
    return scored.groupBy(shard_col).agg(
        F.sum(hit).alias("correct"), F.count(F.lit(1)).alias("rows")).withColumn(
        "accuracy", F.col("correct") / F.lit(float(size)))


def global_accuracy(scored: DataFrame, n_rows: int, label: str = "label") -> DataFrame:
    """The exact figure over the distinct rows (padding copies, ``pos >= n``,
    left out) that the per-worker numbers approximate (Q6)."""
    return accuracy(scored.filter(F.col("pos") < F.lit(n_rows)), label)


def running_loss(batch_losses: DataFrame, by: Sequence[str] = ("trial_id", "epoch"),
                 loss_col: str = "batch_loss") -> DataFrame:
    """Per (trial, epoch) the mean over steps of the batch loss."""
    return batch_losses.groupBy(*by).agg(
        (F.sum(loss_col) / F.count(F.lit(1))).alias("training_loss"))


def metric_series(scored: DataFrame, epoch_col: str = "epoch", label: str = "label",
                  loss_col: str = "loss") -> DataFrame:
    """One (epoch, loss, accuracy) row per epoch."""
    return scored.groupBy(epoch_col).agg(
        F.avg(loss_col).alias("loss"),
        F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"))


def format_metrics(metrics: DataFrame, epoch_col: str = "epoch") -> DataFrame:
    """The printed line as a column; ``show()`` is the caller's choice."""
    return metrics.withColumn("line", F.format_string(
        "Epoch %d validation: Avg loss=%.2f, Accuracy=%.1f%%",
        F.col(epoch_col), F.col("loss"), F.col("accuracy") * 100.0))
