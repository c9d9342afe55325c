import pytest

from ledgerlens.llm.queries import RANKS, WORD_TOKENIZER

public_tokenizers = pytest.importorskip("public_tokenizers")

SCHEMA = "doc_id long, text string, n_words string, class int, kept string, label int, _page int"


@pytest.fixture(scope="session")
def word_file():
    return public_tokenizers.path(WORD_TOKENIZER)


@pytest.fixture(scope="session")
def rank_file():
    return public_tokenizers.path(RANKS)


@pytest.fixture(scope="session")
def frame(spark):
    """(id, text) pairs -> documents with extra columns whose names clash
    with those the operators use."""

    def make(rows, parts=3):
        full = [(i, t, "x", 1, "y", 2, 3) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, long, repeated and tied texts."""
    long = " ".join(f"w{k % 977}x{k % 13}" for k in range(60_000))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one two"), (5, "one two"), (5, "one two"), (6, "One  two"),
        (7, long), (8, "é 日本 \U0001f642 ünï"), (None, "one two"), (None, None), (9, "a\nb\na\nb\n" * 40),
        (10, "x" * 5000),
    ]
