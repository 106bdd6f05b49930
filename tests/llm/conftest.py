from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd(spark):
    """Nulls everywhere, empty, wordless and very long texts, ties, repeated rows, names that clash with outputs."""
    rows = [
        (1, "the cat sat on the mat and the dog", "en", "a", 3), (1, "the cat sat on the mat and the dog", "en", "a", 3), (2, None, "de", "a", None), (3, "", None, None, 0), (None, "the cat sat on the mat and the dog", "en", "b", 1), (4, " \t\n ", "en", "b", 1),
        (5, "12 345 !!", "en", None, 2), (6, "word " * 60_000, "en", "a", 4), (7, "le chat est sur la table et le chien", "fr", "b", 1), (8, "x", "fr", "b", 1), (9, None, None, None, None), (10, "é" * 30_000, "fr", "c", 1),
    ]
    from pyspark.sql import functions as F

    extra = {n: F.lit("own") for n in ("Shard", "slot", "size", "taken", "target", "lang_pred", "score", "selected", "tail_prob", "n_email", "spans", "base", "id", "component", "rep", "n")}
    return spark.createDataFrame(rows, SCHEMA).withColumns(extra)


@pytest.fixture
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
