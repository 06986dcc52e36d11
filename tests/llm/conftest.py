import pytest

A = "The quick brown fox jumps over the lazy dog and runs away from the hungry wolf in the dark forest tonight. "
EDGE = [
    (1, A * 3, "en"), (2, A * 3, "en"), (3, None, None), (4, "", "en"), (5, "one two", None), (6, "one two", "x"), (None, "orphan text " * 4, "en"),
    (7, A * 3 + "extra", "en"), (8, "x" * 5000, "en"), (9, "naïve Émigré don't <|endoftext|> É, ok!! 1.2.3.4 a@b.co " * 40, "fr"), (9, "naïve Émigré don't <|endoftext|> É, ok!! 1.2.3.4 a@b.co " * 40, "fr"),
    (10, "word " * 30000, "en"), (11, " \x1c \n\t\x85 mixed　spaces\x0b", "en"),
]
# extra columns whose names clash with results and with names used inside
COLUMNS = "doc_id long, text string, lang string, n_tokens string, key string, k0 int, n long"


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame([(i, t, la, "x", "k", 1, 2) for i, t, la in EDGE], COLUMNS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
