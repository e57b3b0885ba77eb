"""Classifiers and completeness scores."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from starhouse import rules
from starhouse.functions.text import any_of, contains_pattern, strip


def acquisition_method(credit_line: Column) -> Column:
    """How a work was acquired; the strongest method whose pattern occurs in the credit line wins."""
    credit = F.lower(F.coalesce(credit_line, F.lit("")))
    chain = F
    for method, patterns in rules.ACQUISITION_PATTERNS:
        chain = chain.when(any_of(contains_pattern(credit, pattern) for pattern in patterns), method)
    return chain.otherwise(rules.ACQUISITION_DEFAULT)


def gender(text: Column) -> Column:
    spelled = F.lower(strip(text))
    chain = F
    for label, spellings in rules.GENDER_SPELLINGS.items():
        chain = chain.when(spelled.isin(*spellings), label)
    return chain.otherwise(rules.UNKNOWN)


def nationality(country: Column) -> Column:
    """Adjective of a country: listed exceptions, else the suffix rule."""
    entries = [F.lit(item) for pair in rules.NATIONALITIES.items() for item in pair]
    lowered = F.lower(country)
    by_rule = F.when(
        country.endswith("a"), F.concat(F.substring(lowered, F.lit(1), F.length(lowered) - 1), F.lit("an"))
    ).otherwise(F.concat(lowered, F.lit("ian")))
    return F.coalesce(F.try_element_at(F.create_map(*entries), country), by_rule)


def _weighted(conditions: dict[str, Column], weights: dict[str, int]) -> Column:
    """Sum of the weights whose condition holds, as an exact two-digit decimal."""
    nothing = F.lit(Decimal("0.00"))
    parts = [F.when(conditions[name], F.lit(Decimal(weight).scaleb(-2))).otherwise(nothing) for name, weight in weights.items()]
    return reduce(add, parts).cast("decimal(3,2)")


def artwork_score(
    title: Column, raw_date: Column, acquired: Column, height: Column, width: Column,
    classification: Column, cataloged: Column,
) -> Column:
    return _weighted(
        {
            "title": F.length(title) > 0,
            "creation_date": raw_date != "",
            "acquisition_date": acquired.isNotNull(),
            "dimensions": height.isNotNull() & width.isNotNull(),
            "classification": classification != rules.UNASSIGNED_CLASSIFICATION,
            "cataloged": cataloged,
        },
        rules.ARTWORK_WEIGHTS,
    )


def artist_score(
    birth_year: Column, nationality_text: Column, gender_clean: Column, display_name: Column,
    death_year: Column, is_living: Column, enriched: Column,
) -> Column:
    return _weighted(
        {
            "birth_year": birth_year.isNotNull(),
            "nationality": nationality_text != rules.UNKNOWN,
            "gender": gender_clean != rules.UNKNOWN,
            "display_name": F.length(display_name) > 0,
            "death_or_living": death_year.isNotNull() | is_living,
            "enrichment": enriched,
        },
        rules.ARTIST_WEIGHTS,
    )


def quality_tier(score: Column) -> Column:
    chain = F
    for bound, label in rules.QUALITY_TIERS:
        chain = chain.when(score * 100 >= bound, label)
    return chain.otherwise(rules.LOWEST_TIER)
