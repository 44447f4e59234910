import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp double"
LONG = "a long text about nothing at all " * 40_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows and clashing extra columns."""
    rows = [
        (1, "the same text", "en", "a", 1, "x", 0.5),
        (2, "the same text", "en", "b", 1, "x", 0.5),
        (2, "the same text", "en", "b", 1, "x", 0.5),
        (3, "The same text", None, None, None, None, None),
        (4, None, "de", "a", None, None, None),
        (5, "", "de", "a", 0, "x", 0.5),
        (6, LONG, "en", "c", None, None, None),
        (7, LONG, "en", "c", None, None, None),
        (None, "no id here", "en", None, 3, "x", 0.5),
        (None, "no id here", "en", None, 3, "x", 0.5),
        (8, "12345 --- !!!\n\t", "fr", "a", 3, "x", 0.5),
        (9, "  zwei  leere stellen ▁ \x00 日本語 ́e", "fr", "a", 3, "x", 0.5),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
