import pytest


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing column names."""
    long = "la maison est grande " * 60_000
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again", "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0),
        (4, "   \n ", "en", "a", 4), (5, "one", "en", "b", 3), (6, long, "fr", "b", len(long)), (7, long, "fr", "b", len(long)),
        (8, "the quick brown fox jumps over the lazy dog again", "en", "a", 1), (8, "the quick brown fox jumps over the lazy dog again", "en", "a", 1),
        (None, "no id at all", "en", "a", 12), (9, "password = hunter2hunter2 and token:short", "en", "a", 9), (10, "é" * 3000, "fr", None, 3000),
        (-11, "negative", "en", "a", 8),
    ]
    rows = [(*r, 7, "x", 0.5, [1], "k", 3, "b") for r in rows]
    return spark.createDataFrame(rows, (
        "doc_id long, text string, lang string, source string, n_chars long, "
        "id long, ids string, score double, starts array<int>, key string, n long, blob string")).repartition(3)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")
