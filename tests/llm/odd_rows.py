"""Odd rows that every operator on documents must take."""

import pytest

ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, kept string, node string, label string, rate double, `__n` int"


@pytest.fixture
def odd_docs(spark):
    """NULLs, blanks, ties, repeated rows, a long text, and columns named like the operators' own."""
    words = " ".join(f"Wort{i % 977}x{i}" for i in range(60_000))
    data = [
        (1, "One two three four five six seven."),
        (2, "one TWO three four five six seven."),
        (2, "one TWO three four five six seven."),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, words),
        (None, "no id at all here, none"),
        (7, "é́ <|endoftext|> \x00 ok"),
    ]
    return spark.createDataFrame([(i, t, None, "a" if i == 1 else None, None, "d", "k", "n", "l", 0.5, 9) for i, t in data], ODD)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], ODD)
