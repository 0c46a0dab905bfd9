import pytest
from pyspark.sql import types as T

DATA = "/root/testdata/sf0.001"

LONG = "lorem ipsum dolor sit amet, " * 4_000


@pytest.fixture(scope="session")
def texts(spark):
    """documents of (doc_id, text) rows, with columns whose names clash with those that operators add."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
            T.StructField("score", T.StringType()),
            T.StructField("spans", T.StringType()),
            T.StructField("n_lines", T.StringType()),
            T.StructField("epoch", T.StringType()),
        ]
    )

    def make(rows):
        full = [(*row, *("en", "src0", 1)[len(row) - 2 :], "x", "y", "z", "w") for row in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def odd(texts):
    """Nulls, empty and long texts, repeated rows, ties."""
    return texts(
        [
            (1, None), (2, ""), (3, LONG), (4, LONG), (5, " \n\t"), (6, "a"), (6, "a"), (None, "no number here at all"),
            (7, "\U0001f600 \x00 é ▁ zß"), (8, "one two three four five six seven"), (9, "ONE two three four five six seven"),
        ]
    )


@pytest.fixture(scope="session")
def none(texts):
    return texts([])
