import pytest
from llm_helpers import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, bands int, words string, _row int"
"""The columns of documents, and some that operators use names of."""


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, exact and near copies, repeated rows, ties."""
    base = prose(1, 80)
    texts = [
        (1, base), (2, base), (3, base + " tail1 tail2"), (4, prose(2, 30)), (5, ""), (6, None), (7, " \t\n"),
        (8, prose(3, 12_000)), (9, "one two"), (10, "one two"), (None, prose(4, 40)), (11, prose(5, 25)), (11, prose(5, 25)),
        (12, "é ñ \u00a0 ß " + prose(6, 25)), (13, "spam " * 60), (14, prose(7, 40).upper()),
    ]
    return [
        (i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"src{k % 3}", None, 99, "r", 7, "w", 5)
        for k, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def as_dealt(spark):
    """Partitions stay as they were dealt out, however small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
