"""The corpus pipeline: quality, SimHash copies, benchmark passages, mix, token files.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``; each works on all rows its predecessor kept.  With
null or empty texts, repeated rows or an empty table the stages behave as their
operators' docstrings say.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import contamination, dac, mixing, quality, simhash
from strata.llm.common import labelled_sample, remainder, table
from strata.llm.queries import MAX_TRAIN, new_folder, tokenizer_path
from strata.session import ensure_checkpoint_dir, ship_package


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps (score 0.7 or more).

    The classifier learns from the labels of the rows of this input that are not held out."""
    keep = ~F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = quality.train(labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", keep, MAX_TRAIN))
    scored = quality.score(docs.withColumn("_pipe_seen", F.col("text")), model, "_pipe_seen", "_pipe_score")
    return scored.where(F.col("_pipe_score") >= quality.KEEP).select(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the smallest id, then the
    smallest hash of the text; of repeated rows one."""
    same = F.xxhash64("text")
    found = simhash.near_duplicates(docs.select("doc_id", same.alias("_pipe_same"), "text"), keep=("_pipe_same",))
    # Per component one (id, text hash), pre-aggregated: a component may hold a third of all rows.
    first = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("_pipe_same").alias("s"))
    keep = found.groupBy("root").agg(F.min(first).alias("k")).select(
        F.col("k.d").alias("_pipe_d"), F.col("k.s").alias("_pipe_s"))
    kept = docs.withColumn("_pipe_same", same).join(
        keep, F.col("doc_id").eqNullSafe(F.col("_pipe_d")) & (F.col("_pipe_same") == F.col("_pipe_s")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_pipe_same"]).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in benchmark passages."""
    path = new_folder(spark, "postings")
    keyed = docs.withColumn("_pipe_key", F.struct("doc_id", F.xxhash64("text").alias("same")))
    contamination.write_index(keyed, path, id_col="_pipe_key")
    found = contamination.contamination(spark, path, table(spark, sf_dir, "benchmark"))
    bad = found.where(contamination.is_contaminated()).select(
        F.col("doc_id.doc_id").alias("_pipe_d"), F.col("doc_id.same").alias("_pipe_s")).distinct()
    return (docs.withColumn("_pipe_same", F.xxhash64("text"))
            .join(bad, F.col("doc_id").eqNullSafe(F.col("_pipe_d")) & (F.col("_pipe_same") == F.col("_pipe_s")), "left_anti")
            .select(*docs.columns))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The 1-2-3 mix of the sources: each row as often as it is taken."""
    return mixing.mixed_docs(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: place, length and crc32 of each row."""
    path = new_folder(spark, "tokens")
    dac.write(docs, path, tokenizer_path())
    return dac.digest(spark, path)


def _shipped(stage: Callable) -> Callable:
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        return stage(spark, docs, sf_dir)
    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


STAGES = [("quality", _shipped(quality_stage)), ("simhash", _shipped(simhash_stage)),
          ("decontamination", _shipped(decontamination_stage)), ("mixing", _shipped(mixing_stage)),
          ("tokens", _shipped(token_stage))]

#: Training, components and tokenisation are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, f"pipeline-{uuid.uuid4().hex[:8]}")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
