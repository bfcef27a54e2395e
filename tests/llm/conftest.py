import pytest

#: Nulls in every column, empty and spaced texts, ties, repeated rows, a copy group, near copies, other scripts.
LONG = " ".join(f"word{i % 97}" for i in range(3000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again", "en", "b"),
    (2, "The quick brown  fox jumps over\nthe lazy dog again and again", "en", "a"),
    (3, "The quick brown fox jumps over the lazy dog again and again", "en", None),
    (3, "The quick brown fox jumps over the lazy dog again and again", "en", None),
    (4, None, "en", "a"),
    (5, "", None, "a"),
    (6, "   \t\n", "de", "b"),
    (None, "Größe und Straße, der Hund läuft über die Wiese", "de", "b"),
    (7, LONG, "en", "c"),
    (8, LONG + " extra", "en", "c"),
    (9, "12345 !!! ???", "fr", "a"),
    (10, "Привет мир это текст", None, "d"),
    (11, "日本語のテキスト", None, "d"),
    (12, "one", "en", ""),
    (13, "one two", "en", ""),
    (14, "it's  we'll <|endoftext|> x<|endoftext|>     end ", "en", "a"),
    (15, "a\x1cb ́c ǅ ﬁ İstanbul ΟΔΟΣ", "en", "a"),
]


@pytest.fixture(scope="session")
def rows():
    return ROWS


@pytest.fixture(scope="session")
def docs(spark):
    data = [(i, t, lang, s, len(t or ""), "clash", 0, "x") for i, t, lang, s in ROWS]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, size string, h int, digest string")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
