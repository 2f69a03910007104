import pytest

LONG_WORDS = 30_000


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, names that clash."""
    words = " ".join(f"w{i % 977}x" for i in range(LONG_WORDS))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 60, "k"),
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 60, "k"),
        (2, "", "en", "a", 0, None),
        (3, None, "en", None, None, "k"),
        (None, "a text without an id", None, "b", 20, "k"),
        (4, words, "en", "b", len(words), "k"),
        (5, "   \n\t ", None, None, 6, "k"),
        (6, "1234 5678", "de", "b", 9, "k"),
        (7, "the quick brown fox jumps over the lazy dog again and again", "de", "c", 60, "k"),
    ]
    names = "doc_id long, text string, lang string, source string, n_chars long, row string, fp string, x string, epoch string, best string"
    return spark.createDataFrame([(*r, r[5], r[5], r[5], r[5]) for r in rows], names)


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
