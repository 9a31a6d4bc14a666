import pytest

#: Rows every operator must take: nulls, empty and blank texts, copies, a repeated row, a very long text.
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a"),
    (3, None, None, None), (4, "", "en", "b"), (5, " \t\n ", "de", "b"), (None, "a text without an id but with words", "en", None),
    (6, "one", "en", "a"), (6, "one", "en", "a"), (7, "x" * 5000 + " " + "word " * 30_000, "en", "c"),
    (8, "THE QUICK brown fox jumps over the lazy dog near the old river bank today", "fr", "a"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd rows, with extra columns that have the names operators use for their own."""
    rows = [(*r, len(r[1] or ""), "mine", 5, "k", 0.5) for r in TEXTS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                       "verdict string, n_words int, _key string, score double").coalesce(2)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (6, 0, 1), (None, 1, 1), (99, None, None)], "doc_id bigint, quality int, toxic int")
