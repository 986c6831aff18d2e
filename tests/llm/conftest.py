import pytest

EDGE_TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog."), (2, "The  quick\tbrown fox\njumps over the lazy dog."),
    (3, None), (4, ""), (5, " \n\t "), (6, "A" * 70_000), (7, "word " * 9_000), (8, "Größe und Straße — naïve café 😀"),
    (9, "The quick brown fox jumps over the lazy dog."), (9, "The quick brown fox jumps over the lazy dog."),
    (None, "no id"), (None, "The quick brown fox jumps over the lazy dog."), (10, "a<|endoftext|>b  c \x1c d e"),
    (11, "漢字仮名交じり文 و العربية"), (12, "12345 !!! ??? ..."),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with names used inside the operators."""
    rows = [(i, t, None if k % 4 == 0 else "en", k, "x", 0.5) for k, (i, t) in enumerate(EDGE_TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, bucket int, id string, score double")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, bucket int, id string, score double")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
