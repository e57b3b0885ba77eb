"""URL filters with history: a list's dated entries become intervals, captures meet those of their fetch time.

An entry adds a pattern to a category of the list, or removes it, at some time. Patterns are domains, which
cover their subdomains, or a host with the beginning of a path, by whole segments. A capture's URL is turned
into all patterns that would cover it, and joins intervals by pattern and month. The month bounds what meets
under one pattern; a pattern that very many captures share is split by adaptive joins, as the captures'
side is not grouped there.

Everything here is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.llm.common import columns_but, quoted

#: Seconds of a bucket of time: 30 days.
BUCKET = 30 * 86_400


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port, and a last dot. Null if there is none."""
    rest = F.regexp_replace(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://", "")
    authority = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"(:[0-9]*)?$", "")
    host = F.rtrim(host, F.lit("."))
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """Path as it is written, from its first slash on, without query and fragment."""
    return F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*(/[^?#]*)?", 1)


def patterns_of(url: Column) -> Column:
    """All patterns that cover a URL: its host and the domains above with two labels or more, and its path's beginnings."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda k: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, k, F.size(labels)), ".")))
    parts = F.filter(F.split(path_of(url), "/"), lambda x: x != "")
    paths = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda k: F.concat(F.lit("path:"), host, F.lit("/"), F.array_join(F.slice(parts, 1, k), "/")))
    return F.when(host.isNotNull(), F.concat(domains, F.when(F.size(parts) > 0, paths).otherwise(F.array().cast("array<string>"))))


def intervals(entries: DataFrame) -> DataFrame:
    """pattern, category, since, until (not included; null: open) from entries (pattern, category, action, at).

    ``action`` is add or remove; others, and entries with a null, count for nothing. Of entries of one pattern,
    category and time, a removal wins. Adding again what is on the list only divides an interval.
    """
    known = entries.select("pattern", "category", "action", F.col("at").cast("timestamp").alias("at")).dropna()
    known = known.filter(F.col("action").isin("add", "remove"))
    once = known.groupBy("pattern", "category", "at").agg(F.max(F.col("action") == "remove").alias("removed"))
    # What one task orders is the history of one pattern in one category: list entries, not captures.
    following = F.lead("at").over(Window.partitionBy("pattern", "category").orderBy("at"))
    return once.withColumn("until", following).filter("not removed").select("pattern", "category", F.col("at").alias("since"), "until")


def _bucket(at: Column) -> Column:
    return F.floor(F.unix_seconds(at) / BUCKET)


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched", capture_id: str = "page_id") -> DataFrame:
    """``captures`` with n_rules (active pattern and category pairs that cover the URL), categories (distinct, sorted) and
    blocked (any), which replace columns of those names.

    An entry is active from its time on, up to the next of its pattern and category, that time not included. A
    capture without URL, host or time is covered by nothing. Rows that are equal stay as many as they are. Empty
    tables work: no captures give no rows, no entries block nothing. An entry is a row for each 30 days that it is
    active before the last capture, so one dated far back costs a row a month.
    """
    kept = columns_but(captures, ("n_rules", "categories", "blocked"))
    rows = captures.select(F.struct(*map(quoted, kept)).alias("row"), quoted(url).alias("url"), quoted(capture_id).alias("capture_id"),
                           quoted(fetched).cast("timestamp").alias("fetched"))
    # URL and time are all that decides: what is equal in both is judged once.
    asked = rows.select("url", "fetched").dropna().distinct()
    keyed = asked.withColumn("pattern", F.explode(patterns_of(F.col("url")))).withColumn("bucket", _bucket(F.col("fetched")))
    spans = intervals(entries)
    # Nothing is asked after the last capture, so open intervals end in its bucket.
    last = F.lit(captures.agg(_bucket(F.max(quoted(fetched).cast("timestamp")))).first()[0]).cast("long")
    starts, ends = _bucket(F.col("since")), F.least(last, F.coalesce(_bucket(F.col("until")), last))
    dealt = spans.filter(starts <= last).withColumn("bucket", F.explode(F.sequence(starts, ends)))
    active = (F.col("since") <= F.col("fetched")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until")))
    hits = keyed.join(dealt, ["pattern", "bucket"]).filter(active)
    found = hits.groupBy("url", "fetched").agg(
        F.countDistinct("pattern", "category").alias("n_rules"), F.sort_array(F.collect_set("category")).alias("categories"))
    return rows.join(found, ["url", "fetched"], "left").select(
        "row.*", F.coalesce("n_rules", F.lit(0)).cast("long").alias("n_rules"),
        F.coalesce("categories", F.array().cast("array<string>")).alias("categories"), F.col("n_rules").isNotNull().alias("blocked"))
