import pytest

#: id, text, lang, source: nulls, empties, ties, repeated rows, odd characters and a very long text.
ROWS = [
    (1, "The cat sat on the mat and looked at the dog", "en", "b"),
    (2, "The cat sat on the mat and looked at the dog", "en", "b"),
    (2, "The cat sat on the mat and looked at the dog", "en", "b"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, " \t\n ", "de", "a"),
    (6, "Der Hund und die Katze sind nicht in dem Haus", "de", "a"),
    (7, "1234 !!! 99", None, "c"),
    (8, "Été naïve 你好 \U0001f600 café", "fr", None),
    (None, "no id at all here", "en", "b"),
    (None, "no id at all here", "en", "b"),
    (9, "word " * 30_000, "en", "a"),
    (10, "x" * 5_000, "en", "c"),
    (11, "a  b \n\n c\r\nd", "en", "c"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """With further columns named like those that operators make."""
    rows = [(i, t, lang, s, len(t or ""), 7, "x", 1.5, [1], True) for i, t, lang, s in ROWS]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, "
        "size int, rec string, target double, ids array<int>, kept boolean",
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
