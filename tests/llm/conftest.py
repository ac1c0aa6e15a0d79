import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows."""
    long = " ".join(f"word{i % 977}" for i in range(20_000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "plain words here", "en", None, 3), (3, " \n\t", "en", "s", 3),
            (4, long, "en", "s", len(long)), (5, "same text of the copy", "en", "s", 1), (6, "same text of the copy", "en", "s", 1),
            (5, "same text of the copy", "en", "s", 1), (7, "é ü ß Ñ 中文", None, "s", 9)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
