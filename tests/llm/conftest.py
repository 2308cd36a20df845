import pytest

pytest.importorskip("tickstat.llm")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, key string"


@pytest.fixture
def documents(spark):
    """A documents table with two extra columns named like result columns."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, lang, src, len(t or ""), "x", None) for i, t, lang, src in rows], SCHEMA)
    return make


@pytest.fixture
def odd_documents(documents):
    """NULLs in every column, empty and long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 977}" for i in range(30_000)) + "\n" + "z" * 5_000
    return documents([
        (1, None, None, None), (2, "", "en", "a"), (3, "one", "en", "a"), (3, "one", "en", "a"),
        (3, "another text\nwith two lines", "en", None), (None, "no id here", "de", "b"), (None, None, None, "b"),
        (4, long, "en", "b"), (5, "\n\n  \n", "en", "a"), (6, "café K \U0001F600 naïve", None, "é"),
    ])
