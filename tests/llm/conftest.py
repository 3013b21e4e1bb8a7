import pytest
from pyspark.sql import types as T

DOC = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("score", T.StringType()),  # clashes with a result column
        T.StructField("n_tokens", T.StringType()),
        T.StructField("fp", T.StringType()),
    ]
)
BASE = "The quick brown fox jumps over the lazy dog near the old river bank while seven wise owls watch quietly. "
LONG = " ".join(f"word{i % 997} and{i}" for i in range(20_000))
TEXTS = [
    (1, BASE * 5), (2, BASE * 5), (3, None), (4, ""), (5, "a"), (6, "x" * 3000), (7, LONG), (8, "Zürich\nécole\n\nnaïve 😀 你好"),
    (9, BASE * 3 + "Different ending here, with other words."), (None, "no id at all"), (10, "twice"), (10, "twice"), (-5, "tie"), (11, "tie"),
    (12, "one two three four five six"), (13, " \n\t "), (14, "<|endoftext|> inside <s> text"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    return spark.createDataFrame([(i, t, None, None if i == 3 else f"s{(i or 0) % 2}", None, "x", "y", "z") for i, t in TEXTS], DOC).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(1, 13)] + [(None, 1, 1), (5, None, None), (6, 0, 0)], "doc_id long, quality int, toxic int")
