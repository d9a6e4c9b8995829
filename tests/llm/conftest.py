import pytest


@pytest.fixture()
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with the other columns and some that clash with working names."""

    def make(pairs):
        rows = [(d, t, "en", "src", len(t or ""), "x", 7, "h") for d, t in pairs]
        names = "doc_id long, text string, lang string, source string, n_chars long, words string, n_words int, __text_hash string"
        return spark.createDataFrame(rows, names)

    return make
