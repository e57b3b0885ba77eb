"""Helpers for joins against lookup tables and on optional keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NULL_BUCKETS = 4096


def with_calendar_value(df: DataFrame, key: Column, dim_date: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """Left join of a column of the date dimension; NULL where the key has no date row.

    The dimension is joined as it is: its gate keeps it unique, and adaptive execution broadcasts it by its measured size.
    """
    lookup = dim_date.select(F.col(by).alias("_lookup"), F.col(value).alias("_found"))
    return df.join(lookup, key == F.col("_lookup"), "left").withColumn(name, F.col("_found")).drop("_lookup", "_found")


def spread_nulls(key: Column, spread_by: Column) -> Column:
    """Join key whose NULLs are spread over many values that match nothing.

    In a left join all rows without a key would hash to one partition; here they scatter by
    another column.  The leading NUL character keeps the stand-ins apart from real keys.
    """
    bucket = F.pmod(F.xxhash64(spread_by), F.lit(_NULL_BUCKETS)).cast("string")
    return F.coalesce(key, F.concat(F.lit("\0"), bucket))
