import sys

import pytest

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])


@pytest.fixture(scope="session")
def documents_schema():
    # an id, a text, and names that clash with the operators' own columns
    return "doc_id long, text string, words string, row string, n long, key string, kept boolean"


@pytest.fixture()
def make_docs(spark, documents_schema):
    def make(rows, partitions=3):
        full = [(i, t, "w", "r", 7, "k", False) for i, t in rows]
        return spark.createDataFrame(full, documents_schema).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows, ties, non-ASCII and a long text."""
    long_text = " ".join(f"word{i % 97} thing{i % 13}," for i in range(6000))
    return [(None, "a null id with some words in it"), (1, None), (2, ""), (3, " \t\n "), (4, "one"),
            (4, "one"), (5, "Émile ÉTAIT là, à l'été 2024!\nÉmile ÉTAIT là, à l'été 2024!"), (6, long_text),
            (7, long_text), (8, "x" * 5000), (9, "<|endoftext|> a  b \n\n c<|endoftext|>d   e")]
