import pytest

from edustar.llm.store import importable_by_workers


@pytest.fixture(autouse=True, scope="session")
def _workers(spark):
    importable_by_workers(spark)


@pytest.fixture(scope="session")
def frame(spark):
    """(rows of doc_id, text) -> documents with the usual columns and two whose names clash with results."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t) if t is not None else None, "x", 1.0) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, spans string, score double")
    return make


#: Nulls in both columns, empty and white-space texts, repeated rows, one doc_id with two texts, a very long text and word.
EDGE = [(1, None), (2, ""), (None, "a b c"), (3, "same text here"), (3, "same text here"), (4, "one"), (4, "two words"), (5, " \n\t "),
        (6, "long " * 60_000), (7, "x" * 200_000), (8, "é日本👍🏽 ▁ \x00 ́"), (None, None)]
