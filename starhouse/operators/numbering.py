"""Keys and batch numbers without a global sort."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse import rules

#: Rows that one task numbers, about: the digest prefix that makes the buckets has as many hex digits as that takes.
BUCKET_ROWS = 50_000


def composite_key(high: Column, low: Column) -> Column:
    """Two 32-bit keys in one bigint: unique by construction, equal on every rerun, no shuffle."""
    return high.cast("bigint") * F.lit(2**32) + low.cast("bigint")


def numbered_by_digest(df: DataFrame, key: str, name: str = "row_no") -> DataFrame:
    """Number the rows 1..n in the order of ``md5(key), key``.

    A plain ``row_number()`` over everything would run in one task.  The first digest digits cut
    the rows into even buckets that are already in order; counting them gives each bucket its
    offset and the numbering then runs bucket by bucket.  Keys are expected to be unique; copies of one
    key share a bucket.
    """
    digits = max(1, math.ceil(math.log(max(df.count(), 1) / BUCKET_ROWS, 16)))
    digest = F.md5(F.col(key))
    bucketed = df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, digits))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count("*").alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", key))
    return (
        bucketed.withColumn("_within", within)
        .join(offsets, "_bucket")
        .withColumn(name, F.col("_offset") + F.col("_within"))
        .drop("_bucket", "_digest", "_within", "_offset")
    )


def with_request_batch(df: DataFrame, key: str, size: int = rules.REQUEST_BATCH_SIZE) -> DataFrame:
    """Add ``batch_no`` (from 0): every batch holds exactly ``size`` rows but the last one."""
    numbered = numbered_by_digest(df, key)
    return numbered.withColumn("batch_no", F.floor((F.col("row_no") - 1) / size)).drop("row_no")


#: Batches whose free places are numbered in one task.
_BATCHES = 4096


def sticky_batches(df: DataFrame, key: str, before: DataFrame, size: int = rules.REQUEST_BATCH_SIZE) -> DataFrame:
    """Add ``batch_no`` so that what was asked for under a number stays there.

    ``before`` has ``key`` and ``batch_no`` of the last requests. Keys of both keep their number; new ones, in the order
    of :func:`numbered_by_digest`, fill the places that gone keys left free, lowest batch first, and then new batches.
    Keys are unique in both tables.
    """
    held = before.select(F.col(key).alias("_old"), F.col("batch_no").cast("bigint").alias("_batch"))
    met = df.join(held, F.col(key) == F.col("_old"), "left")
    kept = met.where(F.col("_batch").isNotNull()).withColumnRenamed("_batch", "batch_no").drop("_old")
    new = numbered_by_digest(met.where(F.col("_batch").isNull()).drop("_old", "_batch"), key, "_no")
    # Places are numbered by groups of batches, as ids are by digest: no task sees all batches.
    taken = kept.groupBy("batch_no").agg(F.count("*").alias("n"))
    batches = before.select(F.col("batch_no").cast("bigint").alias("batch_no")).distinct().join(taken, "batch_no", "left")
    free = batches.withColumn("_free", F.greatest(F.lit(size) - F.coalesce("n", F.lit(0)), F.lit(0))).withColumn(
        "_group", F.floor(F.col("batch_no") / _BATCHES))
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = free.groupBy("_group").agg(F.sum("_free").alias("_all")).select("_group", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_offset"))
    inside = F.coalesce(F.sum("_free").over(Window.partitionBy("_group").orderBy("batch_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = free.withColumn("_inside", inside).join(offsets, "_group").where("_free > 0").select(
        "batch_no", F.explode(F.expr("sequence(_offset + _inside + 1, _offset + _inside + _free)")).alias("_place"))
    totals = free.agg(F.coalesce(F.sum("_free"), F.lit(0)).alias("free"), F.coalesce(F.max("batch_no"), F.lit(-1)).alias("last")).first()
    beyond = F.lit(totals["last"] + 1) + F.floor((F.col("_no") - totals["free"] - 1) / size)
    placed = new.join(places, F.col("_no") == F.col("_place"), "left").withColumn("batch_no", F.coalesce("batch_no", beyond)).drop("_no", "_place")
    return kept.unionByName(placed)


def request_batches(df: DataFrame, key: str, size: int = rules.REQUEST_BATCH_SIZE) -> DataFrame:
    """One row per request: its number, its size and its text of prefixed ids."""
    batched = with_request_batch(df.select(key), key, size)
    prefixed = F.concat(F.lit(rules.ENTITY_PREFIX), F.col(key))
    return batched.groupBy("batch_no").agg(
        F.count("*").alias("ids"),
        F.array_join(F.sort_array(F.collect_list(prefixed)), " ").alias("request_text"),
    )
