import pytest

from tests.conftest import SMALL

LONG = "Lang " * 30_000 + "x" * 100_000

#: doc_id, text, lang, source, n_chars, and columns whose names operators use themselves.
AWKWARD = [
    (1, "The cat sat on the mat and looked at the dog.", "en", "a", 45),
    (2, "the CAT sat on the mat and looked at the dog.", "en", "b", 45),
    (2, "the CAT sat on the mat and looked at the dog.", "en", "b", 45),
    (3, None, "en", "a", None),
    (4, "", None, "a", 0),
    (5, " \n\t ", "de", None, 4),
    (6, "word", "de", "b", 4),
    (7, LONG, "en", "a", len(LONG)),
    (8, LONG, "en", "é", len(LONG)),
    (None, "Nobody knows the number of this one at all, he said.", "en", "b", 50),
    (None, None, None, None, None),
    (9, "a\x0bb\x0cc\rd e　f  g ", "fr", "\U0001f600", 15),
    (10, "one line here\none line here\nanother line there\n", "en", "c", 46),
]
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double,"
    " fp long, row long, item long, h long, size long, position double, _id long, key string"
)


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(*r, 0.5, 1, 2, 3, 4, 5, 0.25, 6, "k") for r in AWKWARD]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")
