"""The quick look-ups of the toxicity voters against their plain definitions."""

import zlib

import pytest

from statforge.llm import toxicity as T

TEXTS = (
    "",
    " \n\t ",
    "... !!! «»",
    "You are an idiot, IDIOT! such a stupid-looking Clown.",
    "CAPITALS ONLY!? ÀÉÎ ß ǅ ʰ",
    "días añejos naïve Straße žluťoučký ¿qué? “scum”",
    "日本語 текст عربى á 😀 𝐀𝐁𝐂 𝐚",
    "a ab abc abcd abcde abcdef abcdefg " * 3,
)


def plain_buckets(word):
    parts = (word, "^" + word[:4], "^" + word[:5], word[-4:] + "$")
    return tuple((kind << T.BITS) + (zlib.crc32(part.encode()) & (1 << T.BITS) - 1) for kind, part in enumerate(parts))


@pytest.mark.parametrize("most", [200_000, 3])
def test_rows_give_the_features_and_insults_of_a_text(monkeypatch, most):
    """Also while the table is emptied between texts."""
    monkeypatch.setattr(T, "_MOST_KEPT", most)
    words, insults = T.Rows(), 0
    for text in TEXTS * 2:
        low = text.lower()
        stripped = {token.strip(T._MARKS) for token in low.split()} - {""}
        found, number = words.of(set(low.split()))
        assert found.tolist() == sorted({b for word in stripped for b in plain_buckets(word)}) == sorted(T.Evidence().of(text).tolist())
        assert number == sum(token.strip(T._MARKS) in T.INSULTS for token in set(low.split()))
        assert T.traits(text, low, number) == T.traits(text)
        insults += number
    assert insults == 2 * 4


def test_capitals_and_letters_are_counted_as_python_does():
    for text in TEXTS:
        assert T._capitals(text) == (sum(map(str.isupper, text)), sum(map(str.isalpha, text)))
