import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (id, text) rows, with the other columns filled in."""

    def make(rows, **more):
        out = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(out, "doc_id long, text string, lang string, source string, n_chars long")

    return make
