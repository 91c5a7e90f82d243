import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, row string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names clash with those the operators add."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "own", "own") for i, t in rows], DOCUMENTS)
    return make
