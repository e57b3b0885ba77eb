"""Quality gates.  A gate is a DataFrame of ``check, failures``; :func:`enforce` raises on failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse import schemas
from starhouse.operators.dealing import dealt


class QualityError(ValueError):
    """A gate found failures."""


def _result(df: DataFrame, check: str, failures) -> DataFrame:
    return df.agg(F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures")).select(F.lit(check).alias("check"), "failures")


def _union(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def unique(df: DataFrame, keys: Sequence[str], name: str, tasks: int | None = None) -> DataFrame:
    """Number of keys that occur more than once, counted in ``tasks`` partitions (:mod:`dealing`)."""
    repeated = dealt(df.select(*keys), tasks, *keys).groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
    return _result(repeated, f"{name} unique ({', '.join(keys)})", F.count("*"))


def not_null(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Rows without a value, per required column, all counted in one pass."""
    counted = df.agg(*[F.count_if(F.col(column).isNull()).alias(column) for column in columns])
    entries = F.array(*[
        F.struct(F.lit(f"{name}.{column} not null").alias("check"), F.col(column).alias("failures")) for column in columns
    ])
    return counted.select(F.explode(entries).alias("e")).select("e.check", "e.failures")


def references(child: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str) -> DataFrame:
    """Rows whose value is missing in the parent.

    The child is counted per value first, so a frequent value meets the parent as one row.
    """
    values = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(F.count("*").alias("_rows"))
    orphans = values.join(parent.select(F.col(parent_column).alias("_value")), "_value", "left_anti")
    return _result(orphans, name, F.sum("_rows"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, n``: the rows of every table, one count each."""
    return _union([
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()
    ])


def minimum_rows(tables: Mapping[str, DataFrame], minimums: Mapping[str, int]) -> DataFrame:
    """Rows that a table lacks to its minimum; 0 for a table that is large enough."""
    return _union([
        _result(tables[name], f"{name} has at least {least} rows", F.greatest(F.lit(least) - F.count("*"), F.lit(0)))
        for name, least in minimums.items()
    ])


def _key(columns: Sequence[str]) -> Column:
    """A text that equal keys alone have; a missing part is told from an empty one."""
    parts = [F.coalesce(F.replace(F.col(x).cast("string"), F.lit("\0"), F.lit("\0\0")), F.lit("\0N")) for x in columns]
    return F.concat_ws("\0S", *parts)


def declared_gates(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every key, reference and required column declared for the given tables.

    A table is read once: each row gives one entry per check, as (check, key) with what it counts for. Entries of all
    tables are added up in every task, then shuffled once, so that a frequent value arrives as one entry per task.
    A missing value of a required column gives an entry, others none.
    """
    names: list[str] = []

    def number(check: str) -> int:
        names.append(check)
        return len(names) - 1

    def entry(check: int, key: Column, child: int, parent: int) -> Column:
        return F.struct(F.lit(check).alias("check_no"), key.alias("key"), F.lit(child).cast("bigint").alias("child"), F.lit(parent).cast("bigint").alias("parent"))

    entries: dict[str, list[Column]] = {name: [] for name in tables}
    unique_checks, null_checks = [], []
    for name in tables:
        for keys in schemas.UNIQUE_KEYS.get(name, []):
            unique_checks.append(number(f"{name} unique ({', '.join(keys)})"))
            entries[name].append(entry(unique_checks[-1], _key(keys), 1, 0))
        for column in schemas.REQUIRED_COLUMNS.get(name, []):
            null_checks.append(number(f"{name}.{column} not null"))
            entries[name].append(F.when(F.col(column).isNull(), entry(null_checks[-1], F.lit(""), 1, 0)))
        for column, parent, parent_column in schemas.REFERENCES.get(name, []):
            if parent in tables:
                check = number(f"{name}.{column} in {parent}")
                entries[name].append(F.when(F.col(column).isNotNull(), entry(check, _key([column]), 1, 0)))
                entries[parent].append(F.when(F.col(parent_column).isNotNull(), entry(check, _key([parent_column]), 0, 1)))
    spread = [
        tables[name].select(F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("e")).select("e.*")
        for name, found in entries.items() if found
    ]
    by_key = _union(spread).groupBy("check_no", "key").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    failures = (
        F.when(F.col("check_no").isin(unique_checks), (F.col("child") > 1).cast("bigint"))
        .when(F.col("check_no").isin(null_checks), F.col("child")).when(F.col("parent") == 0, F.col("child")).otherwise(F.lit(0))
    )
    found = by_key.groupBy("check_no").agg(F.sum(failures).alias("failures"))
    # Checks that no row had anything to say to have no failures.
    every = F.explode(F.array(*[F.struct(F.lit(n).alias("check_no"), F.lit(x).alias("check")) for n, x in enumerate(names)]))
    listed = spread[0].sparkSession.range(1, numPartitions=1).select(every.alias("e")).select("e.*")
    return listed.join(found, "check_no", "left").select("check", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"))


def enforce(gates: DataFrame) -> None:
    """Raise when a check has failures.  A gate has one row per check, so the rows are few."""
    failed = gates.where("failures > 0").collect()
    if failed:
        raise QualityError("; ".join(f"{row['check']}: {row['failures']} failures" for row in failed))
