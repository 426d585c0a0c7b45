import pytest

from tidemark.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, words string, kept string"
LONG = "the quick brown fox jumps over a lazy dog\n" * 3000


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    words = " ".join(f"word{i}" for i in range(80))
    rows = [
        (1, words, "en", "a"),
        (2, words, "en", "a"),
        (2, words, "en", "a"),
        (3, None, "en", None),
        (4, "", None, "a"),
        (None, words + " end", None, None),
        (5, LONG, "fr", "b"),
        (6, " \n\t\n ", "fr", "b"),
        (7, "Ünïcode   and spaces\r\n\x1c\x85  x  ", "de", "b"),
        (8, "s t u p i d 1d10t! ...", "de", "c"),
        (None, None, None, None),
    ]
    return spark.createDataFrame([(*r, None, "k", "w", "x") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
