"""Report and analytic queries over the warehouse tables.

Limits are part of the reports.  Each ordered report breaks ties by a key, so its rows are fixed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse import rules
from starhouse.functions.classify import quality_tier


def _top(df: DataFrame, measure: str, *ties: str, limit: int = 10) -> DataFrame:
    return df.orderBy(F.desc(measure), *ties).limit(limit)


# --- Counts and shares ---------------------------------------------------------------------


def category_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def percent_of_total(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """Rows per value and their share of all rows in percent.

    The total is a scalar subquery over the grouped counts, so no window has to gather them.
    """
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.select(F.sum("n")).scalar()
    share = F.round(F.col("n") * F.lit(100.0) / total, digits).alias("percentage")
    return counts.select(column, "n", share).orderBy(F.desc("n"), column)


def top_shares(df: DataFrame, column: str, limit: int = 10) -> DataFrame:
    """The most frequent values with their share of all rows."""
    return percent_of_total(df, column).limit(limit)


def completeness(df: DataFrame, columns: Sequence[str], with_share: Sequence[str] = ()) -> DataFrame:
    """One row: all rows, rows with a value per column, and chosen shares in percent."""
    counts = [F.count(F.col(name)).alias(f"has_{name}") for name in columns]
    shares = [F.round(F.try_divide(F.count(F.col(name)) * F.lit(100.0), F.count("*")), 1).alias(f"pct_{name}") for name in with_share]
    return df.agg(F.count("*").alias("total"), *counts, *shares)


def quality_tiers(df: DataFrame) -> DataFrame:
    """Rows and mean score per completeness tier."""
    return (
        df.groupBy(quality_tier(F.col("data_quality_score")).alias("quality_tier"))
        .agg(F.count("*").alias("n"), F.round(F.avg("data_quality_score"), 2).alias("avg_score"))
        .orderBy(F.desc("avg_score"))
    )


def star_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with the row count of every table, as scalar subqueries side by side."""
    spark = next(iter(tables.values())).sparkSession
    counts = [df.select(F.count("*")).scalar().alias(name) for name, df in tables.items()]
    return spark.range(1).select(*counts)


def sample(df: DataFrame, columns: Sequence[str], present: str, order: Sequence[str | Column], limit: int = 5) -> DataFrame:
    """A few rows that have a value in ``present``, first by the given order."""
    return df.where(F.col(present).isNotNull()).orderBy(*order).select(*columns).limit(limit)


# --- Artists and geography -----------------------------------------------------------------


def top_nationalities(artists: DataFrame, limit: int = 10) -> DataFrame:
    known = artists.where(F.col("nationality") != rules.UNKNOWN)
    return _top(known.groupBy("nationality").agg(F.count("*").alias("artist_count")), "artist_count", "nationality", limit=limit)


def by_continent(geography: DataFrame) -> DataFrame:
    return (
        geography.where(F.col("continent").isNotNull()).groupBy("continent")
        .agg(F.count("*").alias("n"), F.sum("total_artists").alias("total_artists"))
        .orderBy(F.desc("total_artists"), "continent")
    )


def top_geography(geography: DataFrame, limit: int = 10) -> DataFrame:
    present = geography.where("total_artists > 0").select(
        "nationality", "country_name", "continent", "total_artists", "total_artworks"
    )
    return _top(present, "total_artists", "nationality", limit=limit)


# --- Years ---------------------------------------------------------------------------------


def era_distribution(calendar: DataFrame) -> DataFrame:
    return (
        calendar.groupBy("era")
        .agg(F.count("*").alias("years"), F.min("year").alias("start_year"), F.max("year").alias("end_year"))
        .orderBy("start_year")
    )


def calendar_summary(calendar: DataFrame) -> DataFrame:
    """One row: the range of years and how many periods and eras they span."""
    return calendar.agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        F.count_distinct("economic_period").alias("economic_periods"), F.count_distinct("era").alias("eras"),
    )


def war_or_recession_years(calendar: DataFrame) -> DataFrame:
    chosen = F.col("era").isin(*rules.WAR_ERAS) | (F.col("economic_period") == rules.RECESSION)
    return calendar.where(chosen).select("year", "era", "economic_period").orderBy("year")


def recession_years(economics: DataFrame, limit: int = 10) -> DataFrame:
    recessions = economics.where(F.col("economic_period") == rules.RECESSION)
    return _top(recessions.select("year", "economic_period", "major_events"), "year", limit=limit)


def chosen_years(economics: DataFrame, years: Sequence[int] = (1929, 1950, 1975, 2000, 2020, 2024)) -> DataFrame:
    return (
        economics.where(F.col("year").isin(*years))
        .select("year", "gdp_usd_billions", "inflation_rate_percent", "economic_period").orderBy("year")
    )


# --- Links between artworks and artists ----------------------------------------------------


def bridge_coverage(bridge: DataFrame) -> DataFrame:
    return bridge.agg(
        F.count("*").alias("relationships"),
        F.count_distinct("artwork_id").alias("artworks_with_artists"),
        F.count_distinct("artist_id").alias("artists_with_artworks"),
    )


def collaborations(bridge: DataFrame, limit: int = 10) -> DataFrame:
    counted = bridge.groupBy("artwork_id").agg(F.count("artist_id").alias("artist_count")).where("artist_count > 1")
    return _top(counted, "artist_count", "artwork_id", limit=limit)


def prolific_artists(artists: DataFrame, limit: int = 10) -> DataFrame:
    present = artists.where("total_artworks_in_collection > 0")
    return _top(present, "total_artworks_in_collection", "artist_id", limit=limit).select(
        "display_name", "total_artworks_in_collection", "first_acquisition_year", "last_acquisition_year"
    )


# --- Star schema ---------------------------------------------------------------------------


def artist_movements(artist_dim: DataFrame, geography_dim: DataFrame, summary: DataFrame, limit: int = 10) -> DataFrame:
    """Artists with the most works, their movements and country.

    The ranking only needs the summary, and a nationality names one country, so the ranked few
    are cut before the dimensions join.
    """
    ranked = _top(summary.where("total_artworks > 20").select("artist_id", "total_artworks"), "total_artworks", "artist_id", limit=limit)
    artists = artist_dim.select("artist_id", "display_name", "nationality", "art_movements")
    countries = geography_dim.select("nationality", "country_name")
    return (
        artists.join(F.broadcast(ranked), "artist_id").join(countries, "nationality", "left")
        .orderBy(F.desc("total_artworks"), "artist_id")
        .select("display_name", "country_name", "art_movements", "total_artworks")
    )


def top_artists(acquisitions: DataFrame, artist_dim: DataFrame, geography_dim: DataFrame, limit: int = 10) -> DataFrame:
    """The artists with the most acquisitions and their country.

    Acquisitions are counted per artist first, so the joins see one row per artist.
    """
    counted = acquisitions.groupBy("artist_id").agg(F.count("*").alias("_rows"))
    named = (
        counted.join(artist_dim.select("artist_id", "display_name", "nationality"), "artist_id")
        .join(geography_dim.select("nationality", "country_name"), "nationality")
        .groupBy("display_name", "country_name")
        .agg(F.sum("_rows").alias("artworks"))
    )
    return _top(named, "artworks", "display_name", "country_name", limit=limit)


def recession_acquisitions(acquisitions: DataFrame, dates_dim: DataFrame) -> DataFrame:
    """Acquisitions per recession year, counted per date key before the join."""
    counted = acquisitions.groupBy("acquisition_date_key").agg(F.count("*").alias("_rows"))
    recessions = dates_dim.where(F.col("economic_period") == rules.RECESSION).select("date_key", "year", "economic_period")
    return (
        counted.join(recessions, F.col("acquisition_date_key") == F.col("date_key"))
        .groupBy("year", "economic_period").agg(F.sum("_rows").alias("acquisitions")).orderBy("year")
    )
