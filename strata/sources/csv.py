"""A1/A2: CSV scans with an explicit schema (no inference pass over the data).

Malformed rows fail the job (``FAILFAST``) instead of turning into nulls,
as a typed read should; under ANSI mode a bad number cannot slip through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             header: bool = True) -> DataFrame:
    """A1: CSV with a header line; columns typed by ``schema``."""
    return (spark.read.schema(schema).option("header", header)
            .option("mode", "FAILFAST").csv(path))


def read_csv_positional(spark: SparkSession, path: str, names: Sequence[str],
                        types: Sequence[str]) -> DataFrame:
    """A2: headerless CSV; column i gets ``names[i]`` and ``types[i]``."""
    schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, types))
    return read_csv(spark, path, schema, header=False)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).csv(path)
