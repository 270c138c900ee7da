import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text[, lang[, source]]) rows."""
    def made(rows):
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
    return made


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, repeated rows, ties and equal ids."""
    long = " ".join(f"word{i % 997} item{i}" for i in range(40_000))
    text = " ".join(f"alpha{i}" for i in range(60))
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (4, text, "en", "a"), (4, text, "en", "a"), (5, text, "en", None),
        (None, text, None, "a"), (None, None, None, None), (6, long, "en", "b"), (7, long + " end", "en", "b"), (8, "one", "fr", "b"), (9, "é ß 😀 日本", None, "c"),
        (8, "two", "fr", "b"),
    ]
