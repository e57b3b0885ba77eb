"""Shuffles whose tasks hold a bounded number of rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

#: Rows of a shuffle that one task sorts or groups, about.
TASK_ROWS = 500_000


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Partitions for a shuffle of so many rows; None where a core's share of them is small enough.

    Adaptive execution joins partitions by compressed bytes, down to about one a core: narrow rows that compress well
    make tasks of many millions.  It leaves partitions alone whose number is given.
    """
    tasks = math.ceil(rows / TASK_ROWS)
    return tasks if tasks > spark.sparkContext.defaultParallelism else None


def dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """``df`` parted by ``keys`` into so many partitions; as it is for None."""
    return df if tasks is None else df.repartition(tasks, *keys)
