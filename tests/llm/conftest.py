import pytest

from millrace.session import let_workers_import

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, kept boolean"
LONG = " ".join(f"word{n % 97}" for n in range(20000))
EDGE = [
    (1, "the quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, " \t\n "), (5, LONG),
    (5, LONG), (None, "no id here"), (None, None), (6, "x"), (7, "a" * 5000), (8, "The QUICK brown fox jumps over the lazy dog"),
    (9, "<|endoftext|> <|endoftext|>x 'll 12 éß 中文 😀"),
]


@pytest.fixture(scope="session")
def workers(spark):
    return let_workers_import(spark)


@pytest.fixture(scope="session")
def edge(workers):
    rows = [(i, t, None, None if i == 6 else "s", 1, 0.5, "mine", False) for i, t in EDGE]
    return workers.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(workers):
    return workers.createDataFrame([], SCHEMA)
