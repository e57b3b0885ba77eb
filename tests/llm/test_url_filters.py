from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from starhouse.llm import url_filters as U

ENTRIES = [
    ("domain:bad.org", "spam", "add", "2024-01-10"), ("domain:bad.org", "spam", "remove", "2024-03-01"), ("domain:bad.org", "spam", "add", "2024-06-01"),
    ("domain:bad.org", "spam", "add", "2024-06-01"), ("domain:bad.org", "adult", "add", "2024-02-01"), ("path:ok.net/a/b", "malware", "add", "2024-01-01"),
    ("domain:x.y.bad.org", "spam", "add", "2020-01-01"), ("domain:tie.com", "spam", "add", "2024-05-05"), ("domain:tie.com", "spam", "remove", "2024-05-05"),
    ("domain:bad.org", "spam", "noise", "2024-02-01"), (None, "spam", "add", "2024-01-01"), ("domain:com", "spam", "add", None), ("domain:localhost", "own", "add", "2024-01-01"),
]
CAPTURES = [
    (1, "http://www.bad.org/x?y#z", "2024-01-09", ""), (2, "https://WWW.bad.org:8080/x", "2024-01-10", "spam"), (3, "http://u:p@bad.org", "2024-02-10", "adult,spam"),
    (4, "bad.org/x", "2024-03-01", "adult"), (5, "http://bad.org./", "2024-07-01", "adult,spam"), (6, "http://notbad.org/", "2024-07-01", ""),
    (7, "http://ok.net/a/b/c", "2024-07-01", "malware"), (8, "http://ok.net/a/bc", "2024-07-01", ""), (9, "http://ok.net/a//b/", "2024-07-01", "malware"),
    (10, "http://z.x.y.bad.org/", "2021-07-01", "spam"), (11, "http://tie.com/", "2024-07-01", ""), (12, None, "2024-07-01", ""), (13, "", "2024-07-01", ""),
    (14, "http://bad.org/", None, ""), (15, "http:///nohost", "2024-07-01", ""), (None, "http://bad.org/", "2024-07-01", "adult,spam"), (2, "https://WWW.bad.org:8080/x", "2024-01-10", "spam"),
    (16, "http://localhost/", "2024-07-01", "own"), (17, "http://ok.net/" + "d/" * 3000, "2024-07-01", ""),
]


def frames(spark, captures, entries):
    at = lambda x: x and datetime.fromisoformat(x)
    return (
        spark.createDataFrame([(i, url, at(t), "mine", 7) for i, url, t, _ in captures], "page_id long, url string, fetched timestamp, blocked string, pattern int"),
        spark.createDataFrame([(p, c, a, at(t)) for p, c, a, t in entries], "pattern string, category string, action string, at timestamp"),
    )


def test_captures_meet_entries_of_their_time(spark):
    found = U.judge(*frames(spark, CAPTURES, ENTRIES))
    assert found.columns == ["page_id", "url", "fetched", "pattern", "n_rules", "categories", "blocked"]
    rows = sorted((repr(x["page_id"]), x["url"] or "", ",".join(x["categories"]), x["blocked"], x["n_rules"] > 0) for x in found.collect())
    assert rows == sorted((repr(i), url or "", expected, expected != "", expected != "") for i, url, _, expected in CAPTURES)


def test_many_captures_of_one_host(spark):
    """Half of all captures on one host, over many months; one interval covers some of them."""
    _, entries = frames(spark, [], [("domain:hot.com", "spam", "add", "2024-02-01"), ("domain:hot.com", "spam", "remove", "2024-02-11")])
    captures = spark.range(20_000).select(
        F.col("id").alias("page_id"), F.when(F.col("id") % 2 == 0, "http://hot.com/p").otherwise(F.concat(F.lit("http://h"), "id", F.lit(".com/"))).alias("url"),
        (F.lit("2024-01-01").cast("timestamp").cast("long") + F.col("id") * 864).cast("timestamp").alias("fetched"))
    assert U.judge(captures, entries).filter("blocked").count() == 500


def test_empty_tables(spark):
    captures, entries = frames(spark, CAPTURES, [])
    assert U.judge(captures, entries).filter("blocked").count() == 0 and U.judge(captures, entries).count() == len(CAPTURES)
    captures, entries = frames(spark, [], ENTRIES)
    assert U.judge(captures, entries).count() == 0
