"""Years and dates written as free text, and the calendar parts derived from a year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starhouse import rules
from starhouse.functions.text import any_of, starts_with_any, strip, to_number

_FOUR_DIGITS = "([0-9]{4})"


def date_text(raw: Column) -> Column:
    """The free-text date as the rules look at it: stripped, never NULL."""
    return strip(F.coalesce(raw, F.lit("")))


def year_runs(text: Column) -> Column:
    """All four-digit runs of the text, in order."""
    return F.regexp_extract_all(text, F.lit(_FOUR_DIGITS), F.lit(1))


def creation_date(text: Column, runs: Column) -> Column:
    """Struct ``(creation_year int, date_certainty string)`` of a free-text date.

    ``text`` is :func:`date_text` and ``runs`` its :func:`year_runs`; both are taken as columns so
    that a caller can project them once.  Listed prefixes decide first and keep their certainty
    even without a year.  A short text with a hyphen and exactly two years is a range (midpoint,
    rounded down).  Otherwise the first four-digit run counts if it lies in the accepted years.
    """
    first = F.get(runs, F.lit(0)).cast("int")
    second = F.get(runs, F.lit(1)).cast("int")
    is_range = text.contains("-") & (F.length(text) <= rules.RANGE_MAX_LENGTH) & (F.size(runs) == 2)

    def outcome(year: Column, certainty: str) -> Column:
        return F.struct(year.cast("int").alias("creation_year"), F.lit(certainty).alias("date_certainty"))

    return (
        F.when(starts_with_any(text, rules.CIRCA_PREFIXES), outcome(first, "circa"))
        .when(starts_with_any(text, rules.DATED_PREFIXES), outcome(first, "exact"))
        .when(is_range, outcome(F.floor((first + second) / 2), "range"))
        .when(first.between(*rules.CREATION_YEARS), outcome(first, "exact"))
        .otherwise(outcome(F.lit(None), "unknown"))
    )


def iso_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text to a date, anything else to NULL.

    The mask leaves only full dates to the cast, which is much faster than a format pattern.
    """
    return F.when(text.like("____-__-__"), text).try_cast("date")


def life_year(text: Column) -> Column:
    """Birth or death year: numeric text cut to its whole part, kept inside the accepted years."""
    year = to_number(strip(text)).try_cast("int")
    return F.when(year.between(*rules.LIFE_YEARS), year)


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def century(year: Column) -> Column:
    """Whole hundreds of the year, so 1999 gives 19."""
    return F.floor(year / 100).cast("int")


def date_key(year: Column) -> Column:
    """Integer ``yyyymmdd`` key of January 1st."""
    return (year * 10000 + 101).cast("int")


def first_of_january(year: Column) -> Column:
    return F.make_date(year, F.lit(1), F.lit(1))


def era(year: Column) -> Column:
    """Name of the historical era; a missing year has no era."""
    chain = F.when(year.isNull(), F.lit(None).cast("string"))
    for last_year, name in rules.ERAS:
        chain = chain.when(year <= last_year, name)
    return chain.otherwise(rules.LATEST_ERA)


def economic_period(year: Column) -> Column:
    """Recession inside one of the listed ranges, else expansion: a predicate, not a range join."""
    recession = any_of(year.between(start, end) for start, end in rules.RECESSIONS)
    return F.when(recession, rules.RECESSION).otherwise(rules.EXPANSION)


def major_event(year: Column) -> Column:
    """Event text of the year from a literal map, NULL for an uneventful year."""
    entries = [F.lit(item) for pair in rules.MAJOR_EVENTS.items() for item in pair]
    return F.try_element_at(F.create_map(*entries), year)
