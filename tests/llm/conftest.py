import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, very long, tied and repeated rows."""
    long = "alpha beta gamma delta epsilon zeta " * 4000
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t", None, None, 3), (4, long, "en", "a", len(long)),
            (5, "same words in this short text", "en", None, 5), (5, "same words in this short text", "en", None, 5),
            (6, "same words in this short text", "de", "b", 5), (7, "one", "de", "b", 1), (None, "no id here at all", None, "b", 9)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
