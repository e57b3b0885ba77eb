"""Tables in parts by a hash of their key, of which an update rewrites only those that changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART = "part"


def _part(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _digests(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per part: rows, and sums of two digests of them, whatever their order. Counted in every task before the shuffle."""
    rows = [F.xxhash64(*columns), F.xxhash64(F.lit(1), *reversed(columns))]
    return df.groupBy(PART).agg(F.count("*").alias("rows"), *[F.sum(x.cast("decimal(38,0)")).alias(f"digest{n}") for n, x in enumerate(rows)])


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def write_parts(df: DataFrame, path: str, key: str, parts: int) -> None:
    """``df`` anew, in ``parts`` folders by a hash of ``key``."""
    df.withColumn(PART, _part(key, parts)).repartition(PART).write.mode("overwrite").partitionBy(PART).parquet(path)


def read_parts(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path`` with the columns of ``like``, which are those that were written."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def update_parts(df: DataFrame, path: str, key: str, parts: int, scratch: str) -> list[int]:
    """Make the table at ``path`` equal to ``df``, and return the parts that had to be written again.

    ``df`` is computed once, into ``scratch``. Old and new rows are compared by digests of whole parts, so no row is
    shuffled to find out; parts without a change keep their files. Rows removed or added change their part, and a part
    that has no rows any more goes. ``parts`` must be that of the table.
    """
    spark, columns = df.sparkSession, df.columns
    df.withColumn(PART, _part(key, parts)).write.parquet(scratch)
    schema = df.withColumn(PART, _part(key, parts)).schema
    new, old = (spark.read.schema(schema).parquet(x) for x in (scratch, path))
    a, b = _digests(new, columns).alias("a"), _digests(old, columns).alias("b")
    same = F.lit(True)
    for name in ("rows", "digest0", "digest1"):
        same &= F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    compared = a.join(b, PART, "full").where(~same).select(PART, F.col("a.rows").isNull().alias("gone")).collect()  # a row per part
    changed, gone = [x[PART] for x in compared if not x["gone"]], [x[PART] for x in compared if x["gone"]]
    if changed:
        new.where(F.col(PART).isin(changed)).repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    for part in gone:
        where, files = _files(spark, f"{path}/{PART}={part}")
        files.delete(where, True)
    spark.catalog.refreshByPath(path)
    return sorted(changed + gone)
