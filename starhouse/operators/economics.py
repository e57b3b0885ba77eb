"""Yearly economic series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starhouse import rules
from starhouse.functions.dates import economic_period, iso_date, major_event
from starhouse.functions.text import to_number

_OBSERVATIONS_SCHEMA = "observations array<struct<date: string, value: string>>"


def parse_observations(responses: DataFrame, payload: str = "payload") -> DataFrame:
    """Landed series responses (``series``, JSON text) to ``series, observed_on, value``.

    Observations without a number are dropped, as are ones without a date.
    """
    observations = F.from_json(F.col(payload), _OBSERVATIONS_SCHEMA)["observations"]
    return (
        responses.select("series", F.explode(observations).alias("o"))
        .select("series", iso_date(F.col("o.date")).alias("observed_on"), to_number(F.col("o.value")).alias("value"))
        .dropna()
    )


def annual_average(observations: DataFrame) -> DataFrame:
    """``series, year, value``: mean of the year's observations."""
    return observations.groupBy("series", F.year("observed_on").alias("year")).agg(F.avg("value").alias("value"))


def year_spine(spark: SparkSession, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1, numPartitions=1).select(F.col("id").cast("int").alias("year"))


def on_spine(spine: DataFrame, annual: DataFrame, columns: dict[str, str] = rules.SERIES_COLUMNS) -> DataFrame:
    """Every spine year with one column per series, NULL where a series has no value.

    One pivot brings all series to year grain, so the spine is joined once and not per series.
    """
    wide = annual.groupBy("year").pivot("series", list(columns)).agg(F.first("value", ignorenulls=True))
    renamed = wide.withColumnsRenamed(columns)
    return spine.join(renamed, "year", "left")


def percent_change(value: Column, by_year: Window) -> Column:
    """Change against the year before in percent, gaps filled forward (a gap year gives 0)."""
    filled = F.last(value, ignorenulls=True).over(by_year.rowsBetween(Window.unboundedPreceding, 0))
    before = F.last(value, ignorenulls=True).over(by_year.rowsBetween(Window.unboundedPreceding, -1))
    return (F.try_divide(filled, before) - 1) * 100


def densified(annual: DataFrame) -> DataFrame:
    """``series, year, value`` with every year from a series' first to its last; a year without a value has NULL.

    Each series has its own years, however many series there are: a sequence per series, met by its values.
    """
    spans = annual.groupBy("series").agg(F.min("year").alias("first"), F.max("year").alias("last"))
    years = spans.select("series", F.explode(F.sequence("first", "last")).alias("year"))
    return years.join(annual.select("series", "year", "value"), ["series", "year"], "left")


def series_change(annual: DataFrame) -> DataFrame:
    """``series, year, value, change_percent``: every year of every series and its change against the year before.

    Gaps are filled forward, as in :func:`percent_change`; the window is that of one series.
    """
    by_year = Window.partitionBy("series").orderBy("year")
    return densified(annual).withColumn("change_percent", percent_change(F.col("value"), by_year))


def economics_table(
    spark: SparkSession, annual: DataFrame, first: int = rules.YEAR_SPINE[0], last: int = rules.YEAR_SPINE[1]
) -> DataFrame:
    """Economics staging table: indicators, inflation, period and event of every spine year.

    The window has no partition: it orders the spine, one row per year.
    """
    year = F.col("year")
    return on_spine(year_spine(spark, first, last), annual).select(
        "year",
        "gdp_usd_billions",
        percent_change(F.col("cpi"), Window.orderBy("year")).alias("inflation_rate_percent"),
        "unemployment_rate_percent",
        "sp500_close",
        major_event(year).alias("major_events"),
        economic_period(year).alias("economic_period"),
        F.current_timestamp().alias("loaded_at"),
        F.lit(rules.ECONOMIC_SOURCE).alias("source"),
    )


def union_series(frames: dict[str, DataFrame]) -> DataFrame:
    """Separate ``year, value`` frames as one long frame of series."""
    tagged = [frame.select(F.lit(name).alias("series"), "year", "value") for name, frame in frames.items()]
    return reduce(DataFrame.unionByName, tagged)
