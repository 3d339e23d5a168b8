import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A frame with the columns of `documents` from (doc_id, text) or (doc_id, text, lang) rows, and one column that clashes with results."""

    def make(rows, extra="n_tokens"):
        full = [(*(list(r) + [None] * 3)[:3], "src", len(r[1] or ""), 7) for r in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {extra} long")

    return make
