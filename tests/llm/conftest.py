import pytest


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text) as documents, with columns whose names operators also use."""

    def make(rows):
        kind = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], kind)

    return make
