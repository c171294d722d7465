import pytest

from speechset.llm.frames import prepare
from tests.conftest import DATA  # noqa: F401

ODD_TEXTS = [None, "", " \n\t ", "one", "two words", "a b c", "x " * 3000, "é 中 😀 café", "same text here again", "same text here again"]


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


def documents(spark, texts, **more):
    """A table with ids from 0, clashing extra columns and the given texts."""
    rows = [(i, t, "en", "web", 7, "extra") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, _a int, counts string")
