import pytest
from pyspark.sql import types as T

LONG = " ".join(f"word{i % 997}" for i in range(30_000))

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def docs(spark):
    """Builds documents from (doc_id, text, source) rows."""
    def build(rows):
        return spark.createDataFrame(
            [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)
    return build


@pytest.fixture
def odd(docs):
    """Null in every column, empty, blank and very long texts, ties and repeated rows."""
    return docs([
        (1, "one two three four five six", "a"), (2, None, "a"), (3, "", None), (4, " \n\t ", "b"),
        (5, LONG, "b"), (6, LONG, None), (None, "one two three four five six", "a"),
        (7, "é ñ 日本 😀 x", "c"), (1, "one two three four five six", "a"), (8, "###", "b"), (None, None, None),
    ])
