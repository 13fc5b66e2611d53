import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, first=0):
    """A documents table of (id, text) or texts."""
    rows = [t if isinstance(t, tuple) else (first + i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        [(i, t, "en", f"src{(i or 0) % 3}", len(t) if t else 0) for i, t in rows], DOCS)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], DOCS)
