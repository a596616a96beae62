import pytest


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text, lang, source) rows."""

    def make(rows):
        full = [(r + (None,) * 4)[:4] + (len(r[1] or "") if len(r) > 1 else 0,) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make
