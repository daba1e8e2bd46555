import pytest


@pytest.fixture
def documents(spark):
    """Rows to documents, with an extra column and one whose name an operator might use itself."""

    def make(texts, ids=None):
        rows = [(ids[k] if ids else k, t, "en", "src", len(t or ""), "x", "y") for k, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, key string")

    return make
