"""Typed tables: conforming to the declared columns, writing and reading."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starhouse import schemas
from starhouse.operators.rejects import ACCEPTED, KEY, REJECTED
from starhouse.sources import versions

_VALUE = "column_name: string, raw_value: string, reason: string"


def _typed(df: DataFrame, table: str) -> dict[str, Column]:
    present = set(df.columns)
    return {
        name: (F.col(name) if name in present else F.lit(None)).try_cast(kind)
        for name, kind in schemas.TABLES[table].items()
    }


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's declared columns in order and type; values that do not fit become NULL."""
    return df.select(*[column.alias(name) for name, column in _typed(df, table).items()])


def rejected_values(df: DataFrame, table: str) -> DataFrame:
    """``column_name, rejected``: how many values :func:`conform` cannot convert, in one pass."""
    typed = {name: column for name, column in _typed(df, table).items() if name in df.columns}
    counted = df.agg(*[
        F.count_if(F.col(name).isNotNull() & column.isNull()).alias(name) for name, column in typed.items()
    ])
    entries = F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(name).alias("rejected")) for name in typed])
    return counted.select(F.explode(entries).alias("e")).select("e.*")


def layer_of(table: str) -> str:
    return next(layer for layer, tables in schemas.LAYERS.items() if table in tables)


def table_path(folder: str, table: str) -> str:
    """Where a set of tables has this one. Tables with quarantine lie in parts: the accepted rows, and the rejected values."""
    part = "/kind=accepted" if table in schemas.QUARANTINED else ""
    return f"{folder.rstrip('/')}/{layer_of(table)}/{table}{part}"


@dataclass(frozen=True)
class Written:
    """Outcome of one table write: its rows, per column the values that did not fit the type, and per reason the rows left out."""

    rows: int
    rejected: dict[str, int]
    dropped: dict[str, int] = field(default_factory=dict)


def write_table(df: DataFrame, folder: str, table: str, at: datetime | None = None) -> Written:
    """Full refresh of one table of a set.

    Values that do not fit are observed while the rows stream to the files; rows are counted from the
    written file footers.  Neither runs the plan a second time.  ``at`` is the time for the load stamps.

    A table with quarantine may have what :func:`starhouse.operators.rejects.tagged` adds: accepted rows and rejected values then
    leave the same pass as two folders, the values that do not fit among the latter.
    """
    if at is not None:
        df = df.withColumns({name: F.lit(at) for name in schemas.LOAD_STAMPS if name in schemas.TABLES[table]})
    typed = {name: column for name, column in _typed(df, table).items() if name in df.columns}
    accepted = F.col(ACCEPTED) if ACCEPTED in df.columns else F.lit(True)
    observation = Observation()
    observed = df.observe(observation, *[
        F.count_if(accepted & F.col(name).isNotNull() & column.isNull()).alias(name) for name, column in typed.items()
    ])
    path = table_path(folder, table)
    if REJECTED in df.columns:
        whole = path.rsplit("/", 1)[0]
        _split(observed, table).write.mode("overwrite").partitionBy("kind").parquet(whole)
        files = df.sparkSession._jvm.org.apache.hadoop.fs.Path(whole).getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
        for kind in ("accepted", "rejected"):
            files.mkdirs(df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{whole}/kind={kind}"))
    else:
        conform(observed, table).write.mode("overwrite").parquet(path)
    rejected = {name: count for name, count in observation.get.items() if count}
    return Written(read_table(df.sparkSession, folder, table).count(), rejected)


def _split(df: DataFrame, table: str) -> DataFrame:
    """An entry for each accepted row, and one for each rejected value of any row."""
    typed = _typed(df, table)
    row = F.struct(*[column.alias(name) for name, column in typed.items()])
    no_row = F.lit(None).cast("struct<" + ", ".join(f"{name}: {kind}" for name, kind in schemas.TABLES[table].items()) + ">")
    unfit = [
        F.when(F.col(ACCEPTED) & F.col(name).isNotNull() & typed[name].isNull(), F.struct(
            F.lit(name).alias("column_name"), F.col(name).cast("string").alias("raw_value"), F.lit("does not fit").alias("reason")))
        for name, kind in schemas.TABLES[table].items() if name in df.columns and dict(df.dtypes)[name] != kind
    ]
    values = F.concat(REJECTED, F.filter(F.array(*unfit), lambda x: x.isNotNull())) if unfit else F.col(REJECTED)
    no_value = F.lit(None).cast(f"struct<{_VALUE}>")
    entries = F.concat(
        F.when(F.col(ACCEPTED), F.array(F.struct(F.lit("accepted").alias("kind"), row.alias("row"), no_value.alias("value")))).otherwise(F.array()),
        F.transform(values, lambda x: F.struct(F.lit("rejected").alias("kind"), no_row.alias("row"), x.alias("value"))),
    )
    return df.select(F.col(KEY).alias("row_key"), F.explode(entries).alias("e")).select("e.kind", "e.row.*", "row_key", "e.value.*")


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the current set of ``root``, or of a set's own folder."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in schemas.TABLES[table].items())
    return spark.read.schema(schema).parquet(table_path(versions.current(spark, root), table))


def read_rejected(spark: SparkSession, root: str, table: str) -> DataFrame:
    """``table_name, row_key, column_name, raw_value, reason`` of what a write of the table kept out."""
    path = f"{table_path(versions.current(spark, root), table).rsplit('/', 1)[0]}/kind=rejected"
    return spark.read.schema(f"row_key string, {_VALUE.replace(':', '')}").parquet(path).select(F.lit(table).alias("table_name"), "*")


def register_tables(spark: SparkSession, root: str) -> None:
    """Make the tables of the current set known to SQL as ``staging.*``, ``transformed.*`` and ``dimensional.*``.

    All are of one set, that of the moment of the call; call again after a refresh.
    """
    folder = versions.current(spark, root)
    for layer, tables in schemas.LAYERS.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        for table, columns in tables.items():
            spark.sql(f"DROP TABLE IF EXISTS {layer}.{table}")
            schema = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in columns.items()))
            spark.catalog.createTable(f"{layer}.{table}", path=table_path(folder, table), source="parquet", schema=schema)


def project_filter(df: DataFrame, columns: list[str], required: str) -> DataFrame:
    """Column list and a presence filter; both reach the file scan."""
    return df.where(F.col(required).isNotNull()).select(*columns)
