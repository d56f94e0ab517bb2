"""Small document tables with everything that operators must survive."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, source="src0"):
    rows = [(i, t, "en", source, None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    long = "of the " + " ".join(f"word{i % 977} and other{i}" for i in range(20_000))
    rows = [(1, "the cat sat on the mat of the king today", "en", "a", 40),
            (1, "the cat sat on the mat of the king today", "en", "a", 40),
            (2, None, None, None, None), (3, "", "fr", "b", 0), (4, "   \n\t ", "fr", "b", 5),
            (None, "une ligne de texte sans numéro", "fr", None, 30), (None, None, None, None, None),
            (5, "!!! ???", "en", "a", 7), (6, long, "en", "c", len(long)),
            (7, "the cat sat on the mat of the king today", "en", "b", 40), (8, "word", "en", "a", 4),
            (9, "Ünï cödé \U0001f600 text — with wide characters", "de", "c", 40)]
    return spark.createDataFrame(
        [(*r, i, "x", i) for i, r in enumerate(rows)],
        SCHEMA + ", fp long, _score string, h int").drop()


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def write_tables(spark, folder, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


approx = pytest.approx
