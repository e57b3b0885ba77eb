"""Years with their calendar parts and economic context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.functions import dates


def transform_date_economics(economics: DataFrame) -> DataFrame:
    year = F.col("year")
    return economics.where(year.isNotNull()).select(
        dates.date_key(year).alias("date_key"), dates.first_of_january(year).alias("full_date"), "year",
        dates.decade(year).alias("decade"), dates.century(year).alias("century"), dates.era(year).alias("era"),
        "gdp_usd_billions", "inflation_rate_percent", "unemployment_rate_percent", "sp500_close",
        "economic_period", "major_events",
        F.current_timestamp().alias("created_at"),
    )
