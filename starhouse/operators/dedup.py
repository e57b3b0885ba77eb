"""Handling of repeated keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key in the given order.

    A ``row_number() = 1`` filter lets Spark keep one row per key in every partition before the
    shuffle, so a key with very many copies never gathers in one task.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def drop_repeated(df: DataFrame, key: str) -> DataFrame:
    """Only the rows whose key occurs once; all copies of a repeated key go.

    Counting with a row kept beside the count combines copies before the shuffle, where a window
    count would send every copy of a hot key to one task.
    """
    others = [name for name in df.columns if name != key]
    counted = df.groupBy(key).agg(F.count("*").alias("_copies"), F.any_value(F.struct(*others)).alias("_row"))
    return counted.where("_copies = 1").select(key, "_row.*").select(*df.columns)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    return df.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def duplicate_profile(df: DataFrame, key: str) -> DataFrame:
    """One row: how many keys repeat, how many rows they take, how many a keep-first would drop."""
    return repeated_keys(df, key).agg(
        F.count("*").alias("repeated_keys"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_with_repeated_key"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("rows_dropped_by_keep_first"),
    )


def most_repeated(df: DataFrame, key: str, limit: int = 5) -> DataFrame:
    return repeated_keys(df, key).orderBy(F.desc("copies"), key).limit(limit)
