from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{k % 997}x{k % 31}" for k in range(60_000)) + "."
SENTENCE = "The quick brown fox number {} jumps over the lazy dog near the old river bank today, and it goes on. "


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns that clash with ours."""
    shared = "".join(SENTENCE.format(k) for k in range(8))
    rows = [
        (1, None, "en", "a", None), (2, "", None, None, 0), (3, "  \n\t ", "en", "a", 5), (4, LONG, "en", "b", len(LONG)),
        (5, shared, "en", "a", 1), (6, shared, "en", "b", 1), (5, shared, "en", "a", 1), (7, shared + " tail", None, "a", 1),
        (None, shared, "en", None, None), (None, None, None, None, None), (8, "one two", "de", "c", 7), (9, "123 456", "de", "c", 7),
        (10, "Größe ß ñ 日本 🙂 " * 30, "de", "c", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    clash = ("score", "size", "shard", "h", "col", "fingerprint", "key", "range", "kept", "line", "n", "u", "v", "x", "doc", "copies")
    return df.select("*", *[F.lit(k).alias(k) for k in clash])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
