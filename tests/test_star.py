"""Star schema, geography and reports against brute force in plain Python."""

from __future__ import annotations

import random
from datetime import date

import pytest
from conftest import values
from pyspark.sql import functions as F

from starhouse.plans import geography, reports, star

YEARS = range(1990, 2006)
SNAPSHOT = date(2005, 6, 1)


@pytest.fixture(scope="module")
def world(spark):
    """Artworks of which one has a third of all links, many have none, and one artist is prolific."""
    rng = random.Random(3)
    artists = [(i, f"artist {i}", rng.choice([" French ", "french", "Swiss", None]), rng.choice(["Female", "Male"]), rng.random() < 0.5)
               for i in range(1, 121)]
    artworks = [
        (w, rng.choice([None, *range(1980, 2008)]), rng.choice([None, *YEARS]), rng.choice(["Gift", "Purchase", "Bequest", "Exchange"]))
        for w in range(1, 201)
    ]
    links = {(1, artist[0]) for artist in artists}
    links |= {(w, 1 if rng.random() < 0.5 else rng.randint(1, 120)) for w in range(2, 150) for _ in range(2)}
    calendar = [(year * 10000 + 101, year, "Recession" if year in (1990, 1991, 2001) else "Expansion") for year in YEARS]
    return {
        "artists": artists, "artworks": artworks, "links": links,
        "artists_df": spark.createDataFrame(artists, "artist_id int, display_name string, nationality string, gender_clean string, is_living boolean"),
        "artworks_df": spark.createDataFrame(
            artworks, "artwork_id int, acquisition_year int, creation_year int, acquisition_method string"
        ).withColumns({"accession_number": F.lit("n"), "cataloged": F.lit(True)}),
        "bridge_df": spark.createDataFrame(sorted(links), "artwork_id int, artist_id int").withColumn("artists_total", F.lit(1)),
        "calendar_df": spark.createDataFrame(calendar, "date_key int, year int, economic_period string"),
    }


@pytest.fixture(scope="module")
def facts(world):
    return star.fact_artwork_acquisitions(
        world["artworks_df"], world["bridge_df"], world["artists_df"], world["calendar_df"]
    ).cache()


def expected_facts(world):
    people = {artist[0]: artist for artist in world["artists"]}
    rows = []
    for work, acquired, created, method in world["artworks"]:
        for artist in [a for w, a in world["links"] if w == work] or [None]:
            person = people.get(artist)
            gap = None if acquired is None or created is None else acquired - created
            rows.append((
                work, artist or 0,
                acquired * 10000 + 101 if acquired in YEARS else None,
                created * 10000 + 101 if created in YEARS else None,
                person[2] if person else None,
                None if gap is None else max(gap, 0),
                method == "Gift", person[4] if person else None,
                gap is not None and gap <= 20,
                bool(person and person[3] == "Female"),
            ))
    return sorted(rows, key=repr)


def test_acquisition_facts(world, facts):
    assert values(
        facts, "artwork_id", "artist_id", "acquisition_date_key", "creation_date_key", "nationality",
        "years_from_creation_to_acquisition", "is_gift", "is_living_artist_at_acquisition", "is_contemporary", "is_female_artist",
    ) == expected_facts(world)


def test_hot_work_and_hot_artist_split_over_tasks(spark):
    """One work has a third of all links and one artist another third: shuffled joins split both."""
    works = spark.range(30_000).select(
        F.col("id").cast("int").alias("artwork_id"), F.lit(2000).alias("acquisition_year"), F.lit(1990).alias("creation_year"),
        F.lit("Gift").alias("acquisition_method"), F.lit("n").alias("accession_number"), F.lit(True).alias("cataloged"),
    )
    artists = spark.range(1, 40_001).select(
        F.col("id").cast("int").alias("artist_id"), F.lit("french").alias("nationality"),
        F.lit("Female").alias("gender_clean"), F.lit(True).alias("is_living"),
    )
    hot_work = spark.range(1, 20_001).select(F.lit(7).alias("artwork_id"), F.col("id").cast("int").alias("artist_id"))
    hot_artist = spark.range(10_000, 30_000).select(F.col("id").cast("int").alias("artwork_id"), F.lit(5).alias("artist_id"))
    others = spark.range(8, 10_000).select(F.col("id").cast("int").alias("artwork_id"), (F.col("id") + 20_000).cast("int").alias("artist_id"))
    bridge = hot_work.union(hot_artist).union(others).repartition(16)
    calendar = spark.createDataFrame([(19900101, 1990), (20000101, 2000)], "date_key int, year int")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        built = star.fact_artwork_acquisitions(works, bridge, artists, calendar)
        rows = built.collect()
        plan = built._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == 20_000 + 20_000 + 9_992 + 7
        assert sum(row["artist_id"] == 0 for row in rows) == 7 and sum(row["artist_id"] == 5 for row in rows) == 20_001
        assert plan.count("skew=true") >= 2
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_unlinked_works_do_not_meet_the_artists(world):
    plan = star.fact_artwork_acquisitions(
        world["artworks_df"], world["bridge_df"], world["artists_df"], world["calendar_df"]
    )._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "Inner" in plan and "Cross" not in plan


def test_artist_summary(spark, world, facts):
    names = {artist[0]: artist[2] for artist in world["artists"]} | {0: None}
    artist_dim = spark.createDataFrame([(i, n) for i, n in names.items()] + [(999, None)], "artist_id int, nationality string")
    summary = star.fact_artist_summary(artist_dim, facts, world["artworks_df"], world["calendar_df"], SNAPSHOT)
    created = {work[0]: work[2] for work in world["artworks"]}
    expected = []
    for artist in [*names, 999]:
        mine = [row for row in expected_facts(world) if row[1] == artist]
        acquired = [row[2] // 10000 for row in mine if row[2]]
        made = [created[row[0]] for row in mine if created[row[0]]]
        gaps = [row[5] for row in mine if row[5] is not None]
        expected.append((
            artist, len(mine), min(acquired, default=None), max(acquired, default=None),
            max(acquired) - min(acquired) if acquired else None, min(made, default=None), max(made, default=None),
            float(int(sum(gaps) / len(gaps) + 0.5)) if gaps else None, any(SNAPSHOT.year - year <= 20 for year in made),
        ))
    assert values(
        summary, "artist_id", "total_artworks", "first_acquisition_year", "last_acquisition_year", "span_of_acquisitions_years",
        "earliest_artwork_year", "latest_artwork_year", "avg_years_to_acquisition", "has_contemporary_works",
    ) == sorted(expected, key=repr)
    assert summary.select("artist_summary_key").distinct().count() == len(expected)


def test_geography_counts(spark, world):
    reference = spark.createDataFrame(
        [("France", " French"), ("Swissland", "swiss"), ("Nowhere", "none"), (None, "french")], "country_name string, nationality string"
    ).withColumns({name: F.lit("x") for name in ("country_code_iso2", "country_code_iso3", "continent", "region", "subregion")}).withColumns(
        {name: F.lit(1.0) for name in ("latitude", "longitude")}
    )
    group = {artist[0]: (artist[2] or "").strip().lower() for artist in world["artists"]}

    def counts(nationality):
        members = {artist for artist, name in group.items() if name == nationality}
        return len(members), len({work for work, artist in world["links"] if artist in members})

    expected = [("French".lower(), *counts("french")), ("none", 0, 0), ("swiss", *counts("swiss"))]
    for artworks in (None, world["artworks_df"]):
        built = geography.transform_geography(reference, world["artists_df"], world["bridge_df"], artworks)
        assert values(built, "nationality", "total_artists", "total_artworks") == expected


def test_dimension_has_one_unknown_member(spark, world):
    columns = {
        "birth_year": "int", "death_year": "int", "lifespan_years": "int", "birth_place": "string", "death_place": "string",
        "wikidata_id": "string", "art_movements": "array<string>", "education": "string", "influenced_by": "array<string>",
        "total_artworks_in_collection": "int", "first_acquisition_year": "int", "last_acquisition_year": "int",
        "data_quality_score": "decimal(3,2)", "has_wikidata_enrichment": "boolean",
    }
    artists = world["artists_df"].withColumns({name: F.lit(None).cast(kind) for name, kind in columns.items()})
    dim = star.dim_artist(artists)
    unknown = dim.where("artist_id = 0").collect()
    assert len(unknown) == 1 and unknown[0]["display_name"] == "Unknown Artist" and unknown[0]["total_artworks"] == 0
    assert unknown[0]["has_wikidata_enrichment"] is False and unknown[0]["is_living"] is None
    assert dim.count() == len(world["artists"]) + 1
    assert dim.where("nationality = ' french '").count() == sum(a[2] == " French " for a in world["artists"])


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)], "k string")
    assert [tuple(row) for row in reports.percent_of_total(df, "k").collect()] == [("a", 5, 62.5), ("b", 2, 25.0), (None, 1, 12.5)]
    plan = reports.percent_of_total(df, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Cross" not in plan


def test_recession_acquisitions(world, facts):
    got = [tuple(row) for row in reports.recession_acquisitions(facts, world["calendar_df"]).collect()]
    counts = {year: sum(row[2] == year * 10000 + 101 for row in expected_facts(world)) for year in (1990, 1991, 2001)}
    assert got == [(year, "Recession", n) for year, n in counts.items() if n]
