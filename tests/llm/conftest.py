import pytest
from awkward_rows import AWKWARD


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents from (doc_id, text) with columns whose names clash with inner ones."""

    def make(rows):
        full = [(i, t, "en", "s", len(t or ""), 1, "x", b"y", 2.0) for i, t in rows]
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, id long, label string, packed binary, score double"
        )
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def awkward(documents):
    return documents(AWKWARD)


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])
