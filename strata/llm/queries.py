"""The registered queries of the training-data operators: thin digests of what
the operators return, over whole tables, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import contamination, conversations, dac, lines, mixing, quality, repeats, secrets, simhash, spotsigs, toxicity, whitening, wordpiece
from strata.llm.common import labelled_sample, remainder, table
from strata.session import scratch_path


#: Labelled texts that a classifier is fitted on, at most.
MAX_TRAIN = 8_000


def _held_out(mod: int, rest: int) -> F.Column:
    return F.coalesce(remainder("doc_id", mod) == rest, F.lit(False))


def tokenizer_path() -> str:
    """The public byte-level tokenizer file (installed with the library on every machine)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared checkpoint folder."""
    return scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edit with the next document's text."""
    found = spotsigs.edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256",
                        spotsigs.as_text("signatures").alias("fingerprint"),
                        spotsigs.as_text("edited_signatures").alias("edited_fingerprint"),
                        "near_edited", "near_next")


def op2_wordpiece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return wordpiece.count_tokens(docs, tokenizer_path())


def op3_dac_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: place, length and crc32 of each."""
    path = new_folder(spark, "tokens")
    dac.write(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return dac.digest(spark, path)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; learned from rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sample = labelled_sample(docs, table(spark, sf_dir, "labels"), "quality",
                             ~_held_out(4, 2), MAX_TRAIN)
    scored = quality.score(docs, quality.train(sample))
    return scored.select("doc_id", _held_out(4, 2).alias("held_out"), "score",
                         (F.col("score") >= quality.KEEP).cast("int").alias("predicted"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base findings and what the network adds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs))
    count = lambda kind: F.size(F.filter("findings", lambda f: f.kind == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in secrets.KINDS),
                        F.sha2(secrets.joined("findings", base_only=True), 256).alias("base_sha256"),
                        secrets.joined("findings").alias("spans"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that are copies, near copies, or stay."""
    found = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "n_lines", "n_copies", "n_near",
                        F.array_join(F.col("kept").cast("array<string>"), ",").alias("kept"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; learned from rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sample = labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic",
                             ~_held_out(5, 0), MAX_TRAIN)
    scored = toxicity.score(docs, toxicity.train(sample))
    return scored.select("doc_id", _held_out(5, 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    path = new_folder(spark, "postings")
    contamination.write_index(table(spark, sf_dir, "documents"), path)
    found = contamination.contamination(spark, path, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        contamination.is_contaminated().alias("contaminated"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies and words taken of every document in the 1-2-3 mix of sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    m = mixing.mix(docs)
    return m.select("doc_id", F.col("_mix_size").alias("size"),
                    F.col("_mix_source_size").alias("source_size"),
                    F.col("_mix_target").alias("target"),
                    (F.col("_mix_copies") * F.col("_mix_size")).alias("taken"),
                    F.col("_mix_copies").alias("copies"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select("doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every damaged conversation."""
    return conversations.digest(table(spark, sf_dir, "conversations"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stay when repeated passages go."""
    found = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding, fitted on each distinct vector once."""
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), weights="one")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_spotsigs": op1_spotsigs,
    "op2_wordpiece_counts": op2_wordpiece_counts,
    "op3_dac_tokens": op3_dac_tokens,
    "op4_quality": op4_quality,
    "op5_secrets": op5_secrets,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_mixing": op9_mixing,
    "op10_simhash": op10_simhash,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_whitening": op13_whitening,
}
ORACLE: dict[str, str] = {"op6_line_dedup": lines.ORACLE, "op8_decontamination": contamination.ORACLE, "op9_mixing": mixing.ORACLE,
                          "op11_conversation_repair": conversations.ORACLE, "op12_substring_dedup": repeats.ORACLE}
