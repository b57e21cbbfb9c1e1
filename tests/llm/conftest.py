import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, key string, label int, score string"


@pytest.fixture
def frame(spark):
    """Documents with columns that clash with names the operators use inside."""

    def make(rows):
        full = [(i, t, None, s, len(t or ""), 7, "k", 9, "x") for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def odd_rows():
    """Nulls anywhere, empty and blank texts, one very long text, repeated rows, ties."""
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    some = " ".join(draw.choices(vocabulary, k=120))
    long = " ".join(draw.choices(vocabulary, k=30_000))
    return [
        (1, some, "a"),
        (2, some, "b"),
        (2, some, "b"),
        (3, None, "a"),
        (4, "", None),
        (5, " \n\t\x0b ", ""),
        (None, some, "b"),
        (None, None, None),
        (6, long, "b"),
        (7, "One two\n one  TWO\none two\x1cthree é 漢字 <|endoftext|> ▁x", "a"),
        (8, some + " more", "c"),
        (9, "x" * 5_000, "c"),
    ]
