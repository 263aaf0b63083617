"""Small tables with every awkward case, shared by the tests of the llm operators."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, fp string, ids string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns that clash with results."""
    sentence = "the quick brown fox jumps over the lazy dog while five boxing wizards watch it quietly"
    texts = [
        None, "", " \t\n\x0b", "one", "one two", sentence, sentence, sentence.upper(), sentence + " again",
        "\n".join([sentence] * 4), "é ü 日本語 " * 12, "a | b | c | d | e | f | g | h | i | j | k",
        " ".join(f"w{i % 700}x{i}" for i in range(30000)), "x" * 5000, "na me \x1c sep\x1farated words here",
        "SHOUT!! THIS!! IS!! LOUD!! AND!! LONG!! ENOUGH!! TO!! COUNT!! TWICE!! OK!!",
    ]
    rows = [(i, t, None if i % 3 else "en", None if i % 4 else "src0", None, "clash", "clash", "clash")
            for i, t in enumerate(texts)]
    rows += [(5, sentence, "en", "src1", 3, None, None, None), (None, sentence, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
