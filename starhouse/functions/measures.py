"""Physical dimensions: numeric columns first, the free-text description as a fallback."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text of the first line that is followed by "cm".  The flags make "^" and "." stop at line feeds
# only, so the search is anchored once per line and stays linear on long texts.
_BEFORE_CM = r"(?idm)^(.+?)\s*cm"
_NUMBER = r"([0-9]+\.?[0-9]*)"


def numbers_before_cm(dimensions: Column) -> Column:
    """Array of the number texts that stand before the first "cm"."""
    return F.regexp_extract_all(F.regexp_extract(dimensions, _BEFORE_CM, 1), F.lit(_NUMBER), F.lit(1))


def described_measure(numbers: Column, from_end: int) -> Column:
    """The number that stands ``from_end`` places from the end; needs at least two numbers."""
    value = F.get(numbers, F.size(numbers) - from_end).try_cast("double")
    return F.when(F.size(numbers) >= 2, value)
