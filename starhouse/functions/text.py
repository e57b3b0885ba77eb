"""Text clean-up and lenient casts."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from starhouse import rules

# Plain decimal notation only: a bare cast to double would also take "40d", hex floats and "inf".
# Blanks around it are left to the cast.
_NUMERIC = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"


def strip(text: Column) -> Column:
    """Remove surrounding white space of every kind (``trim`` alone removes only blanks)."""
    return F.btrim(text, F.lit(rules.WHITESPACE))


def blank_tokens(text: Column, tokens: Iterable[str] = rules.NULL_TOKENS) -> Column:
    """NULL where the whole text is one of the no-value tokens."""
    return F.when(~text.isin(*tokens), text)


def empty_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL."""
    return F.when(text.rlike(_NUMERIC), text).try_cast("double")


def to_integer(text: Column) -> Column:
    """Text to int, blanks around it allowed; anything that is not a whole 32-bit number becomes NULL."""
    return text.try_cast("int")


def contains_pattern(text: Column, pattern: str) -> Column:
    """Substring test; only a pattern with a wildcard needs the regex engine."""
    return text.rlike(pattern) if "." in pattern else text.contains(pattern)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)


def starts_with_any(text: Column, prefixes: Iterable[str]) -> Column:
    return any_of(text.startswith(prefix) for prefix in prefixes)


def is_true(text: Column) -> Column:
    """Membership flag for the spellings of "yes"; NULL counts as no."""
    return F.coalesce(F.upper(text).isin(*rules.TRUE_SPELLINGS), F.lit(False))


def equals_ignoring_case(text: Column, word: str) -> Column:
    return F.coalesce(F.lower(text) == word.lower(), F.lit(False))
