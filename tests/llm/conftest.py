import pytest


@pytest.fixture
def docs(spark):
    """Rows with every awkward case: nulls, empty and long texts, repeated rows,
    and an extra column whose name an operator uses itself."""
    long_text = " ".join(f"word{i % 977}" for i in range(30_000))
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "the cat sat on the mat and the dog sat on the log " * 8, "en"), (2, None, "en"), (3, "", None),
            (4, long_text, "en"), (5, base, "de"), (5, base, "de"), (6, base + " tail", "xx"), (None, base, "en"),
            (7, " \n\t ", "fr"), (8, "one two three", "es"), (9, "one  two\nthree", "es"),
            (10, "It's  ''re we'll  x　 ÄÖ 12½ 😀!! <|endoftext|>", "de"), (-3, "Zürich — naïve café", "fr")]
    return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, ids string")


@pytest.fixture
def no_docs(docs):
    return docs.limit(0)
