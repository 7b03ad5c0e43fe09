import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reelmeter.session import ship_package  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with names the operators use."""
    long = " ".join(f"wort{i % 977} und" for i in range(30_000))
    rows = [
        (1, "one two three four five six seven eight nine ten eleven twelve", "a", 1),
        (2, None, "b", 2),
        (3, "", "a", None),
        (4, " \t\n\n ", None, 3),
        (None, "no id here but some words in a row for once", "c", 4),
        (None, "no id here but some words in a row for once", "c", 4),
        (5, long, "a", 5),
        (6, long + " end", "b", 5),
        (7, "one two three four five six seven eight nine ten eleven twelve", "d", 6),
        (7, "one two three four five six seven eight nine ten eleven twelve", "d", 6),
        (8, "É è ü x \U0001f600 <|endoftext|> İstanbul ΑΣ don't", "e", 7),
        (9, "same line\nsame line\n\nother line", "e", 8),
    ]
    schema = "doc_id long, text string, source string, n_chars long"
    frame = spark.createDataFrame(rows, schema)
    names = ["kept", "n_words", "component_id", "first", "digest", "sequence_id", "score", "group", "key", "line", "id"]
    return frame.selectExpr("*", *[f"'x' AS `{n}`" for n in names])


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")
