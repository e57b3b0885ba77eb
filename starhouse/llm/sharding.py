"""Shards by a Feistel permutation of global row numbers.

Rows are numbered in the order of their id: ranges of ids, which Spark samples, are numbered apart and
moved up by the counts of the ranges before. A row number below n is read as a pair (left, right) of
digits to the bases a and b, where a * b is n or a little more, and goes through rounds that add a
keyed mix of one digit to the other: a permutation of the numbers below a * b. A result of n or more
goes through again (cycle walking) until it is below n, which keeps it a permutation of the rows. Result
modulo and divided by the number of shards are shard and slot, so either can be computed from a row
number alone, and the shards' counts are at most one apart.

Everything here is DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.llm.common import columns_but, quoted, stored

ROUNDS = 6
SEED = 77_003
#: Rows of a range that is numbered by one task.
RANGE_ROWS = 100_000
#: Walks after the first. The numbers from n to a * b are fewer than a, so that up to 4,096 rows never need more;
#: beyond, each walk ends with probability 1 - 1 / 64 at least. A row that is still out fails the job.
WALKS = 64
_PRIME = 2_147_483_647


def _mix(digit: Column, key: Column, base: int) -> Column:
    """A number below ``base`` from a digit; all products stay below 2^63."""
    first = (digit % _PRIME * 40_503 + key) % _PRIME
    return (first * first + first * 48_271 + key) % _PRIME % base


def _bases(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _keys(seed: int) -> list[int]:
    keys, x = [], seed
    for _ in range(ROUNDS):
        x = (x * 16_807 + 11) % _PRIME
        keys.append(x)
    return keys


def feistel(number: Column, n: int, seed: int = SEED) -> Column:
    """One walk: a permutation of the numbers below a * b."""
    a, b = _bases(n)
    rounds = F.array(*[F.struct(F.lit(key).cast("long").alias("key"), F.lit(k % 2 == 0).alias("left")) for k, key in enumerate(_keys(seed))])
    digits = F.struct(F.call_function("div", number, F.lit(b)).cast("long").alias("left"), (number % b).cast("long").alias("right"))
    return F.aggregate(
        rounds, digits,
        lambda x, step: F.struct(
            F.when(step.left, (x.left + _mix(x.right, step.key, a)) % a).otherwise(x.left).alias("left"),
            F.when(step.left, x.right).otherwise((x.right + _mix(x.left, step.key, b)) % b).alias("right")),
        lambda x: x.left * b + x.right,
    )


def permuted(number: Column, n: int, seed: int = SEED) -> Column:
    """A permutation of the numbers below n."""
    once = feistel(number, n, seed)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)), once,
        lambda x, _: F.when(x < n, x).otherwise(feistel(x, n, seed)),
    )
    walked = F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walking did not end")).cast("long"))
    return F.when(once < n, once).otherwise(walked)


def numbered(keys: DataFrame, order: list[str], count: str) -> DataFrame:
    """``keys`` with number: the sum of ``count`` over all rows before, in the order of the columns ``order``.

    The input is written to the shared folder, cut into ranges of about RANGE_ROWS rows.
    """
    ranges = max(1, math.ceil(keys.count() / RANGE_ROWS))
    dealt = stored(keys.repartitionByRange(ranges, *map(quoted, order)).withColumn("range", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("range").agg(F.sum(count).alias("sum"))
    # One row per range: a hundred-thousandth of the input.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("range", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"))
    inside = F.sum(count).over(Window.partitionBy("range").orderBy(*map(quoted, order)).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        dealt.withColumn("to", inside).join(offsets, "range")
        .withColumn("number", F.col("offset") + F.col("to") - F.col(count)).drop("range", "to", "offset")
    )


def shard(docs: DataFrame, shards: int = 8, order: list[str] | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` with shard (from 0) and slot (its place there, gapless from 0), which replace columns of those names.

    The order of numbering is that of the columns ``order``: doc_id, unless given. Shards' counts are at
    most one apart. Rows whose order columns are null come first; rows that are equal in them, such as
    repeated rows, get neighbouring numbers, and which gets which may differ between runs if the rest of the
    row differs; they meet in one task. The same rows get the same places, however they are stored or
    partitioned. An empty table stays empty.

    Only the order columns are numbered. Whole rows are shuffled once, to meet their numbers.
    """
    kept = columns_but(docs, ("shard", "slot"))
    keys = {f"key{k}": quoted(x) for k, x in enumerate(order or ["doc_id"])}
    named = [x.alias(k) for k, x in keys.items()]
    counts = stored(docs.select(*named).groupBy(*keys).agg(F.count("*").alias("n")), "keys")
    total = counts.agg(F.sum("n")).first()[0] or 0
    numbers = stored(numbered(counts, list(keys), "n"), "numbers")
    alike = Window.partitionBy(*[F.col(f"d.{k}") for k in keys]).orderBy(F.lit(1))
    rows = docs.select(F.struct(*map(quoted, kept)).alias("row"), *named).alias("d").withColumn("copy", F.row_number().over(alike))
    rows = rows.join(numbers.alias("n"), [F.col(f"d.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    place = permuted(F.col("number") + F.col("copy") - 1, total, seed)
    return rows.select("row", place.alias("place")).select(
        "row.*", (F.col("place") % shards).cast("int").alias("shard"), F.expr(f"place div {shards}").alias("slot"))
