import pytest


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) rows, with further columns that no operator may trip over."""

    def make(rows, **extra):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        full = [(d, t, extra.get("lang"), extra.get("source", "s"), len(t or "")) for d, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def odd_rows():
    """Nulls, empties, blanks, very long texts, repeated rows and ties."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (5, "one two"), (6, long), (7, "x" * 300_000),
        (8, "é" * 1000), (None, "a text without an id, of some words"), (9, "0" * 50_000), (10, "a@" * 5_000), (11, "\n" * 3000),
    ]
