"""What a load leaves out: rows counted by reason, and rejected values tagged beside the rows they come from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.functions.text import to_integer
from starhouse.operators.dedup import repeated_keys

NO_KEY, BAD_KEY, REPEATED_KEY, BAD_LIST_ID = "no key", "bad key", "repeated key", "bad list id"
NO_NUMBER, NO_DATE, NO_YEAR, UNKNOWN_ARTIST = "no number", "no date", "no year", "unknown artist"

#: Columns that a tagged row carries to its write: whether it is accepted, what names it, and its rejected values.
ACCEPTED, KEY, REJECTED = "_accepted", "_row_key", "_rejected"


def tagged(df: DataFrame, accepted: Column, key: Column, checks: Sequence[tuple[str, Column, Column, str]]) -> DataFrame:
    """Rows with what a write needs to part accepted rows from rejected values in one pass.

    A check is (column name, raw text, whether the text is bad, reason). Unused, the three columns cost nothing.
    """
    found = [
        F.when(F.coalesce(bad, F.lit(False)), F.struct(
            F.lit(name).alias("column_name"), raw.cast("string").alias("raw_value"), F.lit(reason).alias("reason")))
        for name, raw, bad, reason in checks
    ]
    values = F.filter(F.array(*found), lambda x: x.isNotNull())
    return df.withColumns({ACCEPTED: accepted, KEY: key.cast("string"), REJECTED: values})


def accepted_rows(df: DataFrame) -> DataFrame:
    return df.where(ACCEPTED).drop(ACCEPTED, KEY, REJECTED)


def _counted(df: DataFrame, count, table: str, reason: str) -> DataFrame:
    n = F.coalesce(count, F.lit(0)).cast("bigint").alias("n")
    return df.agg(n).select(F.lit(table).alias("table_name"), F.lit(reason).alias("reason"), "n")


def bad_keys(staging: DataFrame, key: str, table: str) -> DataFrame:
    """Staging rows whose key is no whole number in range: they have no row in the transformed layer."""
    bad = F.col(key).isNotNull() & to_integer(F.col(key)).isNull()
    return _counted(staging, F.count_if(bad), table, BAD_KEY)


def landing_rejects(raw: DataFrame, key: str, table: str) -> DataFrame:
    """Raw rows without a key, and those that repeat an earlier one's."""
    return _counted(raw, F.count_if(F.col(key).isNull()), table, NO_KEY).unionByName(
        _counted(repeated_keys(raw.where(F.col(key).isNotNull()), key), F.sum(F.col("copies") - 1), table, REPEATED_KEY))


def bad_list_ids(listed_ids: DataFrame) -> DataFrame:
    """Listed artists whose id is no whole number (see ``linking.bad_artist_ids``): they are missing in the bridge."""
    return _counted(listed_ids, F.count("*"), "bridge_artwork_artist", BAD_LIST_ID)
