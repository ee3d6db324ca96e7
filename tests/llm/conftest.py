import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """documents(rows) -> DataFrame of doc_id and text."""
    return lambda rows: spark.createDataFrame(rows, "doc_id long, text string")


# Texts that have upset one operator or another.
ODD = [
    None, "", " ", "\n\n", "a", "İẞ Σ ὈΔΥΣΣΕΎΣ ﬁ ǅ", "<|endoftext|>x<|startoftext|>", "don't we'll 'tis 12345 ①²", "\x1c\x85\xa0  ​",
    "\U0001F600 é é 中文字", "x" * 50_000, "ab " * 20_000, "!?" * 3_000, "word\x01word", "tab\tcr\rend",
]


@pytest.fixture(scope="session")
def odd(documents):
    """The odd texts, one of them twice under one id."""
    rows = list(enumerate(ODD))
    return documents([*rows, rows[5]])


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents([])
