from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def tables(sf_dir):
    return sf_dir


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, hits string, cls string"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with names of the operators."""
    rows = [
        (1, None, "en", "a", 0, 0.5, "x", "y"),
        (2, "", None, "a", 0, None, None, None),
        (3, "one", "en", None, 3, 0.5, "x", "y"),
        (4, "Zwei Wörter", "de", "b", 11, 0.5, "x", "y"),
        (5, " \t\n ", "en", "b", 4, 0.5, "x", "y"),
        (6, "the cat sat on the mat and looked at the dog " * 3, "en", "a", 135, 0.5, "x", "y"),
        (7, "the cat sat on the mat and looked at the dog " * 3, "en", "a", 135, 0.5, "x", "y"),
        (7, "the cat sat on the mat and looked at the dog " * 3, "en", "a", 135, 0.5, "x", "y"),
        (7, "el perro y el gato en la casa de la montaña", "es", "a", 43, 0.5, "x", "y"),
        (None, "a row without an id but with words in it", "en", "b", 40, 0.5, "x", "y"),
        (8, "long " + " ".join(f"w{k}" for k in range(30_000)), "en", "c", 200_000, 0.5, "x", "y"),
        (9, "12345 67890 !!! ???", "en", "c", 19, 0.5, "x", "y"),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)
