"""Helpers for the tests of the text operators."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table like `documents` from (doc_id, text) or (doc_id, text, source)."""

    def make(rows, extra=()):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        frame = spark.createDataFrame(full, DOCS)
        for name in extra:
            frame = frame.selectExpr("*", f"'x' as `{name}`")
        return frame

    return make


@pytest.fixture
def prose():
    """Makes `n` invented words, always the same ones for a seed."""

    def words(n, seed):
        picked = random.Random(seed)
        return " ".join("".join(picked.choice("aeioulnrst") for _ in range(picked.randint(2, 8))) for _ in range(n))

    return words


#: Texts that every operator must take: null, empty, blank, one word, repeated, very long.
ODD = [None, "", "   \n\t", "word", "word word word " * 60, "x" * 70_000, "\u00e9\u4e2d\U0001f600 " * 40]
