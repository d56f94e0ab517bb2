"""A5: append-only tables of per-epoch reports (and any metric rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REPORT_SCHEMA = "trial_id int, epoch int, training_loss double, report_seq long"


def append_reports(reports: DataFrame, path: str) -> None:
    """Append report rows; earlier rows are never rewritten."""
    reports.write.mode("append").parquet(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT_SCHEMA).parquet(path)
