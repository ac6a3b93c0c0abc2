import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _id string, kind string, label string"


@pytest.fixture
def odd_docs(spark):
    """Documents with nulls, empty and long texts, repeated rows and columns with clashing names."""
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    long_text = " ".join(word[(i * i + i // 7) % 12] + str(i % 97) for i in range(30_000))
    data = [
        (1, "one two three four five six seven eight nine ten", "en", "a", 48, "x", "k", "l"),
        (1, "one two three four five six seven eight nine ten", "en", "a", 48, "x", "k", "l"),
        (2, None, "en", "a", None, None, None, None),
        (3, "", None, None, 0, None, None, None),
        (4, "... !!!", "en", "b", 7, None, None, None),
        (None, "one two three four five six seven eight nine ten", None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None),
        (5, long_text, "en", "b", len(long_text), None, None, None),
        (6, "x" * 5000, "de", "b", 5000, None, None, None),
        (7, "one", "de", "c", 3, None, None, None),
    ]
    return spark.createDataFrame(data, DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def rows_of():
    return lambda df: sorted(map(tuple, df.collect()), key=str)
