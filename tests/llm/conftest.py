import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs(spark):
    """A few hand-made rows: null and empty texts, nulls in every column, repeated rows, a very long text."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog.\nIt's a fine day, isn't it?", "en", "a", 70),
        (2, None, "en", "a", None), (3, "", None, None, 0), (4, " \n\t ", "de", "b", 4),
        (5, "Füße über Straßen — 12 Äpfel!!  ok", "de", "b", 30), (6, "x" * 50_000 + " end", "en", "a", 50_004),
        (7, "word " * 20_000, "en", "a", 100_000), (None, "no id here at all", "en", None, 17),
        (1, "The quick brown fox jumps over the lazy dog.\nIt's a fine day, isn't it?", "en", "a", 70),
        (8, "日本語のテキスト 123 😀😀", "ja", "c", 15),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
