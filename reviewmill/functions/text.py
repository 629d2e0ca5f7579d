"""Token expressions on a text column or a token-array column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: letters, then at most one hyphen or apostrophe followed by more letters.
TOKEN_PATTERN = r"[a-zA-Z]+(?:[-'][a-zA-Z]+)?"
MIN_LENGTH = 2


def found(text: Column) -> Column:
    """Every token of the text in order, as it stands there; null text has no tokens."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN_PATTERN), F.lit(0))


def tokenize(text: Column) -> Column:
    """Every token of the text in order, lowercased after matching.

    Lowercasing first would turn some non-ASCII capitals into ASCII letters and so into tokens.
    """
    return F.transform(found(text), F.lower)


def long_enough(tokens: Column, least: int = MIN_LENGTH) -> Column:
    return F.filter(tokens, lambda token: F.length(token) >= least)


def without(tokens: Column, words: Column) -> Column:
    """Drop the words of a short array, keeping duplicates and order of the other tokens.

    The one-element array binds the words, so that an expression for them is computed once per row.
    """
    return F.get(
        F.transform(
            F.array(words), lambda mine: F.filter(tokens, lambda token: ~F.array_contains(mine, token))
        ),
        F.lit(0),
    )


def joined(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def split_tokens(text: Column) -> Column:
    """Tokens of a space-joined text; null and empty text have none."""
    parts = F.split(F.trim(F.coalesce(text, F.lit(""))), r"\s+")
    return F.filter(parts, lambda part: part != "")
