import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, source) rows."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and very long texts, repeated rows, ties, and columns whose names clash with inner ones."""
    from pyspark.sql import functions as F

    words = [f"w{i % 977}" for i in range(60_000)]
    rows = [(1, "one two three four five six", "a"), (1, "one two three four five six", "a"), (2, None, "a"),
            (3, "", None), (4, "   \n\t ", "b"), (5, " ".join(words), "b"), (6, "one two three four five six", None),
            (None, "lost id with some words", "c"), (7, "é ü ß 日本 'tis  it's\x0bok", "c"), (1, "other text here", "a")]
    names = ("id", "size", "fp", "key", "x", "row", "kept", "score", "part", "h", "hash", "rand")
    return make_docs(rows).select("*", *[F.lit("clash").alias(n) for n in names])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
