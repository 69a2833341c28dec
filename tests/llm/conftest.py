from __future__ import annotations

import pytest

LONG = "lorem ipsum dolor sit amet " * 4000

# Nulls in every column, empty and blank texts, a very long one, ties, repeated rows.
EDGES = [
    (1, "The cat sat on the mat and looked at the dog that came in from the rain today.", "en", "a", 80),
    (1, "The cat sat on the mat and looked at the dog that came in from the rain today.", "en", "a", 80),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, " \n\t ", "en", None, 4),
    (5, LONG, "en", "a", len(LONG)),
    (None, "A text without an id but with a mail a.b@example.org and words of its own.", "en", "c", 70),
    (7, "word", "de", "c", 4),
    (7, "other words for the same id", "de", "c", 27),
]
# Columns whose names the operators might use themselves.
CLASHES = ("size", "target", "_row", "node", "h", "n", "place", "bucket", "spans", "kept", "quality", "length", "piece")


@pytest.fixture(scope="session")
def edges(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGES, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES]).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def texts(spark, folder):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
