import pytest


@pytest.fixture
def docs(spark):
    """Builds documents from (doc_id, text) pairs, with extra columns whose names clash with internal ones."""

    def build(rows):
        full = [(i, t, "en", "src0", None if t is None else len(t), 1.0, "x") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score double, blob string")

    return build
