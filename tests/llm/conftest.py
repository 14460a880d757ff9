import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """A function from (id, text) rows to a documents table with clashing extra columns."""

    def make(rows):
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, "
            "fp long, id string, t string, score string, spans string, size string, slot string, shard string, h string"
        )
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t or ""), 7, "x", "y", "z", "u", "v", "w", "q", "r") for i, t in rows], schema
        )

    return make


# Nulls, empties, ties, repeated rows, no id, a very long text.
ODD = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf"),
    (2, None),
    (3, ""),
    (4, " \t\n"),
    (5, "1234 !!! ###"),
    (1, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf"),
    (None, "a row without an id that has some words in it, and mail@example.org too"),
    (6, "word " * 60_000 + "end"),
    (7, "x" * 50_000),
    (8, "Élan ß 日本語 🙂 naïve line space \x00 nul"),
]


@pytest.fixture(scope="session")
def odd(docs):
    return docs(ODD)


@pytest.fixture(scope="session")
def odd_rows():
    return ODD
