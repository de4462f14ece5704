"""Small tables that hold the odd cases every operator must take."""

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# Null id, null and empty and blank texts, repeated rows, one id with two texts, odd characters.
ODD = [
    (1, None, "en", "s", 0),
    (2, "", "en", None, 0),
    (3, " \t\n ", None, "s", None),
    (4, "one", "en", "s", 3),
    (4, "one", "en", "s", 3),
    (5, "two words", "fr", "s", 9),
    (5, "quite another text of the same id", "fr", "s", 9),
    (None, "no id but some words in it", "en", "s", 9),
    (6, "é日本語 👩‍👩‍👧 ﬁ ​ x\x00y\x1cz", "ja", "s", 9),
    (7, "a" * 5000, "en", "s", 5000),
    (8, "word " * 3000, "en", "s", 15000),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with columns whose names operators use themselves."""
    extra = {c: F.lit("x") for c in ("tag", "kept", "n_words", "starts", "_starts", "class", "piece", "length", "spans", "rule")}
    return spark.createDataFrame(ODD, DOCS).withColumns(extra)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


def by_id(df, *columns):
    """doc_id -> the other columns, for tables of one row an id."""
    out = {r[0]: tuple(r)[1:] for r in df.select("doc_id", *columns).collect()}
    assert len(out) == df.count()
    return out
