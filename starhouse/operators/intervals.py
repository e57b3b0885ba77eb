"""Values inside ranges that come as a table.

Ranges are cut at the edges of bins, and those of a bin merged, so that a value meets at most one range of its bin by an
equi-join. Neither a comparison of every value with every range nor a list of all ranges in one place takes part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bin(value: Column, width: int) -> Column:
    return F.floor(value / F.lit(width)).cast("bigint")


def binned_ranges(ranges: DataFrame, width: int, by: Sequence[str] = (), first: str = "first", last: str = "last") -> DataFrame:
    """``bin, low, high`` (both ends inside) of whole-number ranges, per columns ``by``: disjoint within a bin.

    Ranges without an end or with their ends in wrong order hold nothing. A range of length n becomes n / width rows and
    two at most: choose the width near the usual length.
    """
    given = ranges.select(*by, F.col(first).cast("bigint").alias("low"), F.col(last).cast("bigint").alias("high")).where("low <= high")
    cut = given.withColumn("bin", F.explode(F.sequence(_bin(F.col("low"), width), _bin(F.col("high"), width)))).select(
        *by, "bin", F.greatest("low", F.col("bin") * width).alias("low"), F.least("high", F.col("bin") * width + (width - 1)).alias("high"))
    # Equal pieces go before the sort; a piece that begins beyond all before it begins a new range.
    ordered = Window.partitionBy(*by, "bin").orderBy("low", "high")
    reach = F.max("high").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    pieces = cut.distinct().withColumn("_new", (F.coalesce(F.col("low") > reach + 1, F.lit(True))).cast("int"))
    return pieces.withColumn("_range", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*by, "bin", "_range").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).drop("_range")


def with_range_flag(df: DataFrame, value: str, ranges: DataFrame, name: str, width: int, by: Sequence[str] = (),
                    first: str = "first", last: str = "last") -> DataFrame:
    """Add whether the value lies inside a range (of the same ``by``). Rows stay as many as they are; NULL lies in none."""
    binned = binned_ranges(ranges, width, by, first, last).select(*[F.col(x).alias(f"_r_{x}") for x in by], "bin", "low", "high")
    inside = F.col(value).cast("bigint")
    met = (_bin(inside, width) == F.col("bin")) & inside.between(F.col("low"), F.col("high"))
    for column in by:
        met &= F.col(column) == F.col(f"_r_{column}")
    return df.join(binned, met, "left").withColumn(name, F.col("bin").isNotNull()).drop("bin", "low", "high", *[f"_r_{x}" for x in by])
