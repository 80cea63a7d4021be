import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos int, name string"

LONG = "ab cd. " * 3000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and clashing columns."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, "same words in both of these texts", "en", "s", 5),
        (4, "same words in both of these texts", "de", None, 5),
        (4, "same words in both of these texts", "de", None, 5),
        (5, LONG, "en", "s", 5),
        (6, LONG, "fr", "s", 5),
        (7, LONG + "x", "en", "s", 5),
        (8, "x" + LONG, None, "s", 5),
        (9, "éè \U0001f600 \t\x0b 12 !!", "fr", "s", None),
        (10, "   \n ", "en", "s", 5),
        (11, "one", "en", "s", 5),
        (12, "One", "en", "s", 5),
        (-3, "1234 5678 $$$", "en", "s", 5),
        (None, "no id at all", "en", "s", 5),
    ]
    return spark.createDataFrame([(*r, 1, "n") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
