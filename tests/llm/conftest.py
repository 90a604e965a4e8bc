import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def corpus(spark, sf):
    """(doc_id, text) of the smallest documents table."""
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 997}" for i in range(30_000))
    rows = [
        (1, "alpha beta gamma delta " * 20, "en", "a", 5),
        (1, "alpha beta gamma delta " * 20, "en", "a", 5),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \n\t ", "en", "b", 4),
        (5, long, "de", "b", len(long)),
        (None, "no id here at all", "en", "a", 1),
        (7, "Solo", "en", None, 4),
        (8, "SOLO", "en", "a", 4),
        (-9, "naïve 😀 text with password=hunter2hunter2 and ﷐ marker", "en", "a", 3),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    from pyspark.sql import functions as F

    names = ("kept", "score", "rate", "key", "copy", "_w", "component_id", "spans", "ids", "n_words", "hash", "labels", "_bucket")
    names += ("cdf", "parts", "_source", "_key", "_salt", "features", "_raw", "_vector", "_step", "predicted", "label", "fold")
    names += ("_assign", "_hex", "_base", "_covered", "_candidates", "_entropy", "_cut", "secret_spans", "_lines", "_good")
    return spark.createDataFrame(rows, schema).withColumns({n: F.lit("clash") for n in names})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
