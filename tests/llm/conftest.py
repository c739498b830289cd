import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table of the given texts (or (id, text) pairs), spread over a few partitions."""

    def make(texts, parts=3, lang="en"):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, lang, "s", None) for i, t in rows]
        return spark.createDataFrame(rows, DOCS).repartition(parts)

    return make


@pytest.fixture
def odd(spark):
    """Null ids and texts, empty and blank texts, repeated rows, and a column named like one of the operators' own."""
    rows = [(None, "no id at all here"), (1, None), (2, ""), (3, " \n\t "), (4, "same row"), (4, "same row"), (5, "é" * 3), (6, "x" * 70_000)]
    rows = [(i, t, None, None, None, "clash", 7) for i, t in rows]
    return spark.createDataFrame(rows, DOCS + ", spans string, fp int")
