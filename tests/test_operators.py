"""Operators against small hand-made inputs, with brute force where a rule is global."""

from __future__ import annotations

import hashlib
import random

import pytest
from conftest import values
from pyspark.sql import Window
from pyspark.sql import functions as F

from starhouse.operators import dedup, economics, enrichment, linking, lookup, numbering, quality, rejects


# --- Repeated keys ---------------------------------------------------------------------------


def test_keep_first_takes_the_earliest_row(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), ("a", 2, "w")], "k string, o int, v string")
    assert values(dedup.keep_first(df, ["k"], ["o"]), "k", "v") == [("a", "y"), ("b", "z")]


def test_keep_first_cuts_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("WindowGroupLimit") >= 2


def test_drop_repeated_removes_every_copy(spark):
    df = spark.createDataFrame([("Q1", 1), ("Q1", 2), ("Q2", 3), (None, 4)], "q string, v int")
    assert values(dedup.drop_repeated(df, "q"), "q", "v") == [("Q2", 3), (None, 4)]


def test_drop_repeated_with_a_hot_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    assert dedup.drop_repeated(df, "k").count() == 20_000


def test_duplicate_profile(spark):
    df = spark.createDataFrame([(k,) for k in "aaabbc"], "k string")
    assert dedup.duplicate_profile(df, "k").first().asDict() == {
        "repeated_keys": 2, "rows_with_repeated_key": 5, "rows_dropped_by_keep_first": 3,
    }
    assert [tuple(row) for row in dedup.most_repeated(df, "k").collect()] == [("a", 3), ("b", 2)]


# --- Numbering -------------------------------------------------------------------------------


def test_digest_numbering_is_dense_and_ordered(spark):
    ids = [f"Q{n}" for n in random.Random(7).sample(range(10**6), 3_000)]
    numbered = numbering.numbered_by_digest(spark.createDataFrame([(i,) for i in ids], "q string"), "q")
    expected = {q: n for n, q in enumerate(sorted(ids, key=lambda q: (hashlib.md5(q.encode()).hexdigest(), q)), 1)}
    assert dict(values(numbered, "q", "row_no")) == expected


def test_request_batches_are_full_but_the_last(spark):
    df = spark.range(1_234).select(F.concat(F.lit("Q"), "id").alias("q"))
    sizes = sorted(row["ids"] for row in numbering.request_batches(df, "q").collect())
    assert sizes == [34] + [50] * 24
    first = numbering.request_batches(df, "q").orderBy("batch_no").first()
    assert all(part.startswith("wd:Q") for part in first["request_text"].split(" "))


def test_composite_keys_are_unique(spark):
    pairs = [(0, 0), (0, 1), (1, 0), (1, 2**31 - 1), (2, 0), (2**31 - 1, 2**31 - 1)]
    df = spark.createDataFrame(pairs, "a int, b int").select(numbering.composite_key(F.col("a"), F.col("b")).alias("k"))
    assert len({row["k"] for row in df.collect()}) == len(pairs)


# --- Lookups ---------------------------------------------------------------------------------


def test_calendar_value_keeps_misses_and_far_years(spark):
    dim = spark.createDataFrame([(1999, 19990101), (12000, 120000101)], "year int, date_key int")
    df = spark.createDataFrame([(1, 1999), (2, 2000), (3, None), (4, 12000)], "i int, y int")
    found = lookup.with_calendar_value(df, F.col("y"), dim, "year", "date_key", "key")
    assert values(found, "i", "key") == [(1, 19990101), (2, None), (3, None), (4, 120000101)]


def test_only_whole_json_is_an_answer(spark):
    texts = ["<html>502</html>", '{"results": {"bindings": [{"item"', "{}", " [ ] ", "null", "", None, '{"results": {"bindings": []}}', '{"head": {}}']
    df = spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "n int, payload string")
    assert [row["n"] for row in df.where(enrichment.is_answer(F.col("payload"))).orderBy("n").collect()] == [7, 8]


def test_rejects_are_counted_by_reason(spark):
    raw = spark.createDataFrame(
        [(x, "1,2") for x in ("12", "x9", "3000000000", "7.0", None, "12", "12")] + [("13", "1, n.n.,4")], "object_id string, constituent_id string")
    assert values(rejects.landing_rejects(raw, "object_id", "t"), "reason", "n") == [("no key", 1), ("repeated key", 2)]
    assert values(rejects.bad_keys(raw, "object_id", "t"), "reason", "n") == [("bad key", 3)]
    assert values(rejects.bad_list_ids(linking.bad_artist_ids(raw)), "n") == [(1,)]


def test_null_keys_spread_and_match_nothing(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") < 10, F.concat(F.lit("Q"), "id")).alias("q"))
    right = spark.createDataFrame([("Q1",), (None,), ("Q5",)], "r string")
    key = lookup.spread_nulls(F.col("q"), F.col("id"))
    assert left.select(key.alias("k")).distinct().count() > 500
    joined = left.join(right, key == F.col("r"), "left")
    assert joined.count() == 1000 and joined.where(F.col("r").isNotNull()).count() == 2


# --- Enrichment ------------------------------------------------------------------------------


def payload(*bindings):
    import json

    return json.dumps({"results": {"bindings": list(bindings)}})


def binding(qid, **labels):
    item = {} if qid is None else {"item": {"value": f"http://x/entity/{qid}"}}
    return item | {name: {"value": value} for name, value in labels.items()}


RESPONSES = [
    (0, payload(
        binding("Q1", movementLabel="b", educationLabel="x", birthPlaceLabel=""),
        binding("Q1", movementLabel="a", educationLabel="y", birthPlaceLabel="Town"),
        binding("Q1", movementLabel="b", educationLabel="x", birthPlaceLabel="City"),
        binding("Q2", deathPlaceLabel="Grave", birthCountryLabel="Land"),
        binding("Q99", movementLabel="not asked for"),
        binding(None, movementLabel="no item"),
    )),
    (1, None),
    (2, '{"head": {}}'),
]
REQUESTS = [("One", "Q1", 0), ("Two", "Q2", 0), ("Three", "Q3", 0), ("Four", "Q4", 1), ("Five", "Q5", 2), ("Six", "Q6", 3)]


def test_enrichment_collects_in_response_order(spark):
    requests = spark.createDataFrame(REQUESTS, "artist_name string, wikidata_id string, batch_no bigint")
    responses = spark.createDataFrame(RESPONSES, "batch_no bigint, payload string")
    rows = {row["wikidata_id"]: row for row in enrichment.enrich_artists(requests, responses).collect()}
    assert set(rows) == {"Q1", "Q2", "Q3", "Q4", "Q5", "Q6"}
    one = rows["Q1"]
    assert one["movements"] == ["b", "a"] and one["education"] == "x, y" and one["birth_place"] == "Town"
    assert one["influenced_by"] is None and one["bio_text"] is None
    assert rows["Q2"]["death_place"] == "Grave" and rows["Q2"]["birth_place_country"] == "Land"
    statuses = {qid: row["fetch_status"] for qid, row in rows.items()}
    assert statuses == {"Q1": "success", "Q2": "no_data", "Q3": "no_data", "Q4": "failed", "Q5": "no_data", "Q6": "failed"}
    assert rows["Q3"]["batch_no"] == 0 and values(enrichment.raw_responses(responses), "batch_no") == [(0,), (2,)]


def test_entity_with_a_third_of_all_bindings(spark):
    """Labels combine inside their response; order is that of responses, then of positions."""
    hot = [binding("Q0", movementLabel=f"m{pos * 7 % 11}", birthPlaceLabel=f"b{pos}") for pos in range(40)]
    rows = [(n, payload(*hot[n % 5:], *[binding(f"Q{10 * n + k}", movementLabel="x") for k in range(1, 9)])) for n in range(300)]
    collected = enrichment.merged_details(enrichment.response_details(spark.createDataFrame(rows, "batch_no bigint, payload string").repartition(8), "batch_no"))
    assert collected.count() == 2401
    row = collected.where("qid = 'Q0'").first()
    assert row["movements"] == [f"m{pos * 7 % 11}" for pos in range(11)] and row["birth_place"] == "b0"
    assert row["education"] is None and row["influenced_by"] is None


def test_an_entity_in_two_responses_keeps_the_order_of_arrival(spark):
    rows = [(2, payload(binding("Q1", movementLabel="Cubism", bioDescription="later"), binding("Q1", movementLabel="Dada"))),
            (1, payload(binding("Q1", movementLabel="Fauvism"), binding("Q1", movementLabel="Cubism", birthPlaceLabel="Town")))]
    row = enrichment.merged_details(enrichment.response_details(spark.createDataFrame(rows, "batch_no bigint, payload string"), "batch_no")).first()
    assert row["movements"] == ["Fauvism", "Cubism", "Dada"] and (row["birth_place"], row["bio_text"]) == ("Town", "later")


def test_a_response_is_parsed_once(spark):
    responses = spark.createDataFrame([(1, payload(binding("Q1", movementLabel="a")))], "batch_no bigint, payload string")
    plan = enrichment.merged_details(enrichment.response_details(responses, "batch_no"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 0 and plan.count("Aggregate") == 1


def test_odd_bindings_do_not_spoil_the_others(spark):
    texts = ['{"results": {"bindings": [7, null, {"item": 5}, {"item": {"value": "http://x/Q1"}, "movementLabel": {"value": 3}}]}}', '{"results": {"bindings": {}}}', '{"a": 1}}']
    found = enrichment.response_details(spark.createDataFrame(list(enumerate(texts)), "batch_no bigint, payload string"), "batch_no")
    assert [(row["response"], row["qid"], row["movement"]) for row in found.collect()] == [(0, "Q1", ["3"])]


def test_single_response_variant(spark):
    many = [binding("Q1", movementLabel=f"m{n:02}") for n in range(25)]
    responses = spark.createDataFrame(
        [("Q1", payload(*many)), ("Q2", payload(binding("Q2", deathPlaceLabel="Grave"))), ("Q3", payload()), ("Q4", None),
         ("Q1", payload(*many)), ("Q1", payload(*many) + " "), ("Q2", "<html>"), ("Q4", "{")],  # several responses of one entity
        "qid string, payload string",
    )
    requests = spark.createDataFrame([(q, q) for q in ("Q1", "Q2", "Q3", "Q4")], "artist_name string, wikidata_id string")
    found = enrichment.enrich_artists_singly(requests, responses).collect()
    rows = {row["wikidata_id"]: row for row in found}
    assert len(found) == 4 and rows["Q1"]["movements"] == [f"m{n:02}" for n in range(25)]
    assert [rows[q]["fetch_status"] for q in ("Q1", "Q2", "Q3", "Q4")] == ["success", "success", "no_data", "failed"]


# --- Economics -------------------------------------------------------------------------------


def test_percent_change_fills_gaps_forward(spark):
    df = spark.createDataFrame(list(enumerate([None, 100.0, None, 110.0, 121.0, 0.0, 5.0])), "year int, cpi double")
    change = economics.percent_change(F.col("cpi"), Window.orderBy("year"))
    got = [row["c"] for row in df.select("year", F.round(change, 6).alias("c")).orderBy("year").collect()]
    assert got == [None, None, 0.0, 10.0, 10.0, -100.0, None]


def test_observations_without_number_are_dropped(spark):
    document = '{"observations": [{"date": "2000-01-01", "value": "1.5"}, {"date": "2000-07-01", "value": "2.5"}, {"date": "2001-01-01", "value": "."}]}'
    parsed = economics.parse_observations(spark.createDataFrame([("CPI", document)], "series string, payload string"))
    assert parsed.count() == 2
    assert values(economics.annual_average(parsed), "series", "year", "value") == [("CPI", 2000, 2.0)]


def test_economics_table_covers_the_spine(spark):
    annual = spark.createDataFrame(
        [("GDP", 1930, 92.2), ("CPI", 1929, 17.0), ("CPI", 1931, 15.3)], "series string, year int, value double"
    )
    rows = {row["year"]: row for row in economics.economics_table(spark, annual).collect()}
    assert sorted(rows) == list(range(1929, 2025))
    assert rows[1930]["gdp_usd_billions"] == 92.2 and rows[1930]["inflation_rate_percent"] == 0.0
    assert round(rows[1931]["inflation_rate_percent"], 6) == -10.0 and rows[1929]["inflation_rate_percent"] is None
    assert rows[1941]["major_events"] == "US enters World War II" and rows[1941]["economic_period"] == "Expansion"


# --- Bridge ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def linked(spark):
    staging = spark.createDataFrame(
        [("1", "1, 2,3"), ("2", "1"), ("3", ""), ("4", None), ("5", "2,2, x"), ("6", "9"), ("n/a", "1")],
        "object_id string, constituent_id string",
    )
    artists = spark.createDataFrame([(1,), (2,)], "artist_id int")
    artworks = spark.createDataFrame([(1, 1990), (2, 2000), (5, None)], "artwork_id int, acquisition_year int")
    return staging, artists, artworks


def test_bridge_counts_listed_ids_before_unknown_ones_drop(spark, linked):
    staging, artists, artworks = linked
    expected = [(1, 1, 3), (1, 2, 3), (2, 1, 1), (5, 2, 2)]
    assert values(linking.build_bridge(staging, artists), "artwork_id", "artist_id", "artists_total") == expected
    assert values(linking.build_bridge(staging, artists, artworks), "artwork_id", "artist_id", "artists_total") == expected
    assert values(linking.bad_artist_ids(staging), "artwork_id", "listed_id") == [(5, " x")]


def test_artist_stats(spark, linked):
    staging, artists, artworks = linked
    people = artists.unionByName(spark.createDataFrame([(7,)], "artist_id int"))
    bridge = linking.build_bridge(staging, artists)
    names = ("artist_id", "total_artworks_in_collection", "first_acquisition_year", "last_acquisition_year")
    assert values(linking.with_artist_stats(people, bridge, artworks), *names) == [
        (1, 2, 1990, 2000), (2, 2, 1990, 1990), (7, 0, None, None),
    ]


# --- Gates -----------------------------------------------------------------------------------


def test_gates_report_and_raise(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, "a"), (3, None), (3, "c"), (None, None)], "ref int, v string")
    assert quality.references(child, "ref", parent, "id", "fk").first()["failures"] == 2
    assert quality.unique(child, ["ref"], "child").first()["failures"] == 1
    assert values(quality.not_null(child, ["ref", "v"], "child"), "failures") == [(1,), (2,)]
    assert quality.minimum_rows({"child": child}, {"child": 10}).first()["failures"] == 6
    quality.enforce(quality.unique(parent, ["id"], "parent"))
    with pytest.raises(quality.QualityError, match="fk: 2 failures"):
        quality.enforce(quality.references(child, "ref", parent, "id", "fk"))
