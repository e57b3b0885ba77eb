"""The URL filter's query over ``pages``, and its comparison SQL.

``pages`` has neither lists nor fetch times, so both are derived from all of it: a page is fetched
in the hour of its number, and each host enters lists at times that follow from its smallest page number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.llm.common import table
from starhouse.llm.url_filters import host_of, judge

START = "2024-01-01 00:00:00"


def _at(hours):
    return (F.lit(START).cast("timestamp").cast("long") + hours.cast("long") * 3600).cast("timestamp")


def captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", _at(F.col("page_id") * 37 % 8760).alias("fetched"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Hosts are added to a category, some removed after some weeks and added again; some enter by their domain or path."""
    hosts = pages.select(host_of(F.col("url")).alias("host"), "page_id").filter("host is not null").groupBy("host").agg(F.min("page_id").alias("n"))
    domain = F.regexp_replace("host", r"^(?:www|m)\.", "")
    pattern = F.when(F.col("n") % 5 == 2, F.concat(F.lit("path:"), "host", F.lit("/en"))).otherwise(F.concat(F.lit("domain:"), domain))
    category = F.element_at(F.array(F.lit("adult"), F.lit("malware"), F.lit("spam")), (F.col("n") % 3 + 1).cast("int"))
    first = F.col("n") * 53 % 8000
    away = first + 24 * (7 + F.col("n") % 60)
    base = hosts.select("n", pattern.alias("pattern"), category.alias("category"), first.alias("first"), away.alias("away"))
    step = lambda action, hour, there: F.struct(F.lit(action).alias("action"), hour.alias("hour"), there.alias("there"))
    steps = F.array(
        step("add", F.col("first"), F.lit(True)), step("remove", F.col("away"), F.col("n") % 2 == 0),
        step("add", F.col("away") + 240, F.col("n") % 4 == 0))
    return base.select("pattern", "category", F.inline(steps)).filter("there").select("pattern", "category", "action", _at(F.col("hour")).alias("at"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(captures(pages), list_entries(pages)).select(
        "page_id", "n_rules", F.array_join("categories", ",").alias("categories"), "blocked")


ORACLE = r"""
WITH capture AS (
  SELECT page_id, url, (page_id * 37 % 8760) AS hour,
    rtrim(regexp_replace(regexp_replace(regexp_extract(regexp_replace(lower(trim(url)), '^[a-z][a-z0-9+.-]*://', ''), '^([^/?#]*)', 1), '^.*@', ''), '(:[0-9]*)?$', ''), '.') AS host,
    regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*(/[^?#]*)?', 1) AS path
  FROM pages),
hosts AS (SELECT host, min(page_id) AS n FROM capture WHERE host <> '' GROUP BY host),
listed AS (
  SELECT n, CASE WHEN n % 5 = 2 THEN 'path:' || host || '/en' ELSE 'domain:' || regexp_replace(host, '^(?:www|m)\.', '') END AS pattern,
    CASE n % 3 WHEN 0 THEN 'adult' WHEN 1 THEN 'malware' ELSE 'spam' END AS category,
    n * 53 % 8000 AS first, n * 53 % 8000 + 24 * (7 + n % 60) AS away
  FROM hosts),
entry AS (
  SELECT pattern, category, first AS hour, false AS removed FROM listed
  UNION ALL SELECT pattern, category, away, true FROM listed WHERE n % 2 = 0
  UNION ALL SELECT pattern, category, away + 240, false FROM listed WHERE n % 4 = 0),
moment AS (SELECT pattern, category, hour, bool_or(removed) AS removed FROM entry GROUP BY ALL),
covers AS (
  SELECT page_id, hour, unnest(list_concat(
    list_transform(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1), lambda k: 'domain:' || array_to_string(string_split(host, '.')[k:], '.')),
    list_transform(range(1, len(list_filter(string_split(path, '/'), lambda x: x <> '')) + 1),
      lambda k: 'path:' || host || '/' || array_to_string(list_filter(string_split(path, '/'), lambda x: x <> '')[1:k], '/')))) AS pattern
  FROM capture WHERE host <> ''),
latest AS (
  SELECT c.page_id, m.pattern, m.category, arg_max(m.removed, m.hour) AS removed
  FROM covers c JOIN moment m ON m.pattern = c.pattern AND m.hour <= c.hour GROUP BY ALL),
hit AS (
  SELECT page_id, count(*) AS n_rules, array_to_string(list_sort(list(DISTINCT category)), ',') AS categories
  FROM latest WHERE NOT removed GROUP BY page_id)
SELECT c.page_id, coalesce(h.n_rules, 0) AS n_rules, coalesce(h.categories, '') AS categories, h.n_rules IS NOT NULL AS blocked
FROM capture c LEFT JOIN hit h USING (page_id)
"""
