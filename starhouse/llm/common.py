"""Helpers shared by the operators: tables, the shared scratch folder, columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from starhouse.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when it has ended, not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def columns_but(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of ``df`` that an operator passes on: all but those that it writes itself."""
    own = {name.lower() for name in names}
    return [name for name in df.columns if name.lower() not in own]


def quoted(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task makes of a batch stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def per_group(df: DataFrame, keys: list[str], work: Callable[[list[tuple]], list[tuple]], schema: str) -> DataFrame:
    """The rows that ``work`` makes of each group's rows. ``keys`` are the first columns; groups must fit into a task.

    Groups stream through sorted partitions: thousands of small ones cost one Arrow exchange, not one each.
    """
    n, kind = len(keys), to_arrow_schema(StructType.fromDDL(schema))

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [()] * len(kind)
        return pa.RecordBatch.from_arrays([pa.array(x, field.type) for x, field in zip(columns, kind, strict=True)], names=kind.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            found: list[tuple] = []
            for row in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                if rows and rows[0][:n] != row[:n]:
                    found += work(rows)
                    rows = []
                rows.append(row)
            yield batch_of(found)
        if rows:
            yield batch_of(work(rows))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
