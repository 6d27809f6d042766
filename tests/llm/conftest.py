import pytest


@pytest.fixture()
def documents(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, and a column that clashes with inner names."""
    words = "The quick brown foxes, as ever, jumped over lazy dogs.\nÉtat naïve straße 42 don't"
    rows = [
        (1, "plain text of five words", "en", "a", 24, 7),
        (2, None, "en", "a", None, 7),
        (3, "", "de", "b", 0, 7),
        (4, " \t\n ", None, None, 4, 7),
        (5, words * 400, "en", "b", None, None),
        (6, words, "fr", "c", None, 1),
        (6, words, "fr", "c", None, 1),
        (6, "another text of the same id", "fr", "c", None, 1),
        (None, "no id at all", "en", "a", None, 2),
        (8, "x", "en", None, 1, 2),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, part int")
