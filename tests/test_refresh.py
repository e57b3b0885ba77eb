"""The full refresh on landed files, run twice."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import date

import pytest

from starhouse import schemas
from starhouse.operators.quality import QualityError
from starhouse.plans import reports
from starhouse.plans.refresh import Sources, enrichment_requests, run_refresh
from starhouse.sources import csv as csv_source
from starhouse.sources.tables import read_table, register_tables

ARTWORKS = """Title,ConstituentID,Date,Medium,Dimensions,CreditLine,AccessionNumber,Classification,Department,DateAcquired,Cataloged,ObjectID,URL,ImageURL,Height (cm),Width (cm)
Boat,"1, 2",c. 1920,Ink,"12 x 8 1/2"" (30.5 x 21.6 cm)",Gift of X,1.1930,Print,Prints,1930-05-01,Y,10,http://x/10,,,
Tree,1,1950-1960,Oil,,Purchase,2.1970,Painting,Paintings,1970-01-01,Y,11,http://x/11,,100,50
"None",3,n.d.,,,,3,(not assigned),Prints,unknown,N,12,,,,
House,,1990,Wood,,Bequest of Y,4.2008,Design,Design,2008-02-02,Y,13,,,,
Copy,2,2000,Oil,,Given,5,Painting,Paintings,2010-01-01,N,10,,,,
"""
ARTISTS = """ConstituentID,DisplayName,ArtistBio,Nationality,Gender,BeginDate,EndDate,Wiki QID,ULAN
1,Anna,bio,French,Female,1900,1980,Q1,1
2,Bert,bio,American,Male,1930,0,Q2,2
3,Carl,bio,,,0,0,Q2,3
4,Dora,bio,Austrian,F,1950,0,,4
"""
COUNTRIES = [
    {"name": {"common": "France"}, "cca2": "FR", "cca3": "FRA", "region": "Europe", "continents": ["Europe"], "latlng": [46.0, 2.0]},
    {"name": {"common": "United States"}, "cca2": "US", "cca3": "USA", "region": "Americas", "continents": ["North America"], "latlng": [38.0, -97.0]},
    {"name": {"common": "Austria"}, "cca2": "AT", "cca3": "AUT", "region": "Europe", "continents": ["Europe"], "latlng": [47.5, 14.5]},
]


@pytest.fixture(scope="module")
def sources(tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    (root / "Artworks.csv").write_text(ARTWORKS)
    (root / "Artists.csv").write_text(ARTISTS)
    for folder in ("countries", "series", "responses"):
        (root / folder).mkdir()
    (root / "countries" / "all.json").write_text(json.dumps(COUNTRIES))
    for name, values in {"GDP": ["105.0", "110.0"], "CPI": ["10", "11"], "Unemployment": ["5", "."]}.items():
        observations = [{"date": f"{1929 + i}-01-01", "value": value} for i, value in enumerate(values)]
        (root / "series" / f"{name}.json").write_text(json.dumps({"observations": observations}))
    bindings = [{"item": {"value": "http://x/Q1"}, "movementLabel": {"value": m}} for m in ("Cubism", "Dada", "Cubism")]
    (root / "responses" / "0.json").write_text(json.dumps({"results": {"bindings": bindings}}))
    return Sources(
        str(root / "Artworks.csv"), str(root / "Artists.csv"), str(root / "countries"), str(root / "series"), str(root / "responses")
    )


@pytest.fixture(scope="module")
def built(spark, sources, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    minimums = {"transformed_artworks": 4, "transformed_artists": 4, "bridge_artwork_artist": 1}
    first = run_refresh(spark, sources, root, date(2024, 1, 1), minimums)
    second = run_refresh(spark, sources, root, date(2024, 1, 1), minimums)
    assert first == second
    return root, second


def test_every_table_is_written_in_its_types(spark, built):
    root, written = built
    assert set(written) == set(schemas.TABLES)
    for table, columns in schemas.TABLES.items():
        assert dict(read_table(spark, root, table).dtypes) == columns
        assert not written[table].rejected


def test_row_counts(built):
    _, written = built
    assert {table: result.rows for table, result in written.items()} == {
        "staging_artworks": 4, "staging_artists": 4, "staging_requests": 1, "staging_enrichment": 1, "staging_responses": 1, "staging_geography": 4, "staging_economics": 96,
        "transformed_artworks": 4, "transformed_artists": 4, "bridge_artwork_artist": 4, "transformed_geography": 4,
        "transformed_date_economics": 96, "dim_date": 96, "dim_geography": 4, "dim_artist": 5, "dim_artwork": 4,
        "fact_artwork_acquisitions": 5, "fact_artist_summary": 5,
    }


def test_contents(spark, built):
    root, _ = built
    works = {row["artwork_id"]: row for row in read_table(spark, root, "transformed_artworks").collect()}
    assert (works[10]["title"], works[10]["creation_year"], str(works[10]["height_cm"])) == ("Boat", 1920, "30.50")
    assert works[12]["title"] is None and works[13]["acquisition_method"] == "Bequest"
    artists = {row["artist_id"]: row for row in read_table(spark, root, "transformed_artists").collect()}
    assert artists[1]["art_movements"] == ["Cubism", "Dada"] and artists[1]["total_artworks_in_collection"] == 2
    assert artists[2]["has_wikidata_enrichment"] is False and artists[4]["total_artworks_in_collection"] == 0
    facts = {(row["artwork_id"], row["artist_id"]): row for row in read_table(spark, root, "fact_artwork_acquisitions").collect()}
    assert set(facts) == {(10, 1), (10, 2), (11, 1), (12, 3), (13, 0)}
    assert facts[10, 1]["creation_date_key"] is None and facts[11, 1]["creation_date_key"] == 19550101
    years = {row["year"]: row for row in read_table(spark, root, "dim_date").collect()}
    assert str(years[1930]["inflation_rate_percent"]) == "10.00" and years[1930]["unemployment_rate_percent"] is None


def test_reports_on_written_tables(spark, built):
    root, _ = built
    facts, artists, countries = (read_table(spark, root, t) for t in ("fact_artwork_acquisitions", "dim_artist", "dim_geography"))
    assert [tuple(row) for row in reports.top_artists(facts, artists, countries).collect()] == [
        ("Anna", "France", 2), ("Bert", "United States", 1),
    ]
    # The grain is artwork and artist: the work of 1930 has two artists.
    recessions = reports.recession_acquisitions(facts, read_table(spark, root, "dim_date"))
    assert [tuple(row) for row in recessions.collect()] == [(1930, "Recession", 2), (1970, "Recession", 1), (2008, "Recession", 1)]


SQL_REPORTS = {
    "SELECT era, count(*) FROM dimensional.dim_date WHERE year < 1935 GROUP BY era": [("Great Depression", 6)],
    "SELECT department, sum(artists_total) FROM transformed.bridge_artwork_artist JOIN dimensional.dim_artwork USING (artwork_id) GROUP BY 1 ORDER BY 1":
        [("Paintings", 1), ("Prints", 5)],
    "SELECT count(*) FROM transformed.bridge_artwork_artist": [(4,)],
    "SELECT title FROM staging.staging_artworks WHERE title IS NOT NULL ORDER BY object_id": [("Boat",), ("Tree",), ("House",)],
}


@pytest.mark.parametrize("text", list(SQL_REPORTS))
def test_written_tables_answer_sql(spark, built, text):
    register_tables(spark, built[0])
    assert [tuple(row) for row in spark.sql(text).collect()] == SQL_REPORTS[text]


def test_requests_are_known_before_responses_land(spark, sources):
    asked = enrichment_requests(csv_source.land_artists(spark, sources.artists)).collect()
    assert [(row["artist_name"], row["wikidata_id"], row["batch_no"]) for row in asked] == [("Anna", "Q1", 0)]


def test_too_few_rows_stop_the_refresh(spark, sources, tmp_path):
    with pytest.raises(QualityError, match="transformed_artworks 4"):
        run_refresh(spark, sources, str(tmp_path))
    assert not (tmp_path / "dimensional").exists()


def test_a_failed_gate_leaves_the_tables_as_they_were(spark, sources, built):
    root, written = built
    with pytest.raises(QualityError):
        run_refresh(spark, sources, root, date(2024, 1, 1))
    assert all(read_table(spark, root, table).count() == result.rows for table, result in written.items())


def test_bad_keys_stop_the_refresh_unless_allowed(spark, sources, tmp_path):
    spoilt = tmp_path / "Artworks.csv"
    spoilt.write_text(ARTWORKS + 'Bad,"1, two",2000,Oil,,,9,Print,Prints,,N,x14,,,,\nBad,"1, two",2000,Oil,,,9,Print,Prints,,N,15,,,,\n')
    dirty = replace(sources, artworks=str(spoilt))
    minimums = {"bridge_artwork_artist": 1}
    with pytest.raises(QualityError, match="bad key: 1"):
        run_refresh(spark, dirty, str(tmp_path / "w"), date(2024, 1, 1), minimums)
    written = run_refresh(spark, dirty, str(tmp_path / "w"), date(2024, 1, 1), minimums, allowed={"bad key": 1, "bad list id": 1})
    assert written["transformed_artworks"].dropped == {"bad key": 1}
    assert written["bridge_artwork_artist"].dropped == {"bad list id": 1}
    assert written["staging_artworks"].dropped == {"repeated key": 1}


def test_big_file_reader_and_stale_answers(spark, sources, built, tmp_path):
    """The splitting reader gives the same tables; answers under another batch number are found, foreign ones stop the refresh."""
    responses = tmp_path / "responses"
    responses.mkdir()
    bindings = [{"item": {"value": f"http://x/{q}"}, "movementLabel": {"value": "Dada"}} for q in ("Q1", "Q9")]
    (responses / "77.json").write_text(json.dumps({"results": {"bindings": bindings}}))
    other = replace(sources, responses=str(responses), artwork_columns=tuple(ARTWORKS.split("\n")[0].split(",")),
                    artist_columns=tuple(ARTISTS.split("\n")[0].split(",")))
    minimums = {"bridge_artwork_artist": 1}
    with pytest.raises(QualityError, match="nobody asked for: 1"):
        run_refresh(spark, other, str(tmp_path / "w"), date(2024, 1, 1), minimums)
    run_refresh(spark, other, str(tmp_path / "w"), date(2024, 1, 1), minimums, allowed={"bindings nobody asked for": 1})
    one = read_table(spark, str(tmp_path / "w"), "transformed_artists").where("artist_id = 1").first()
    assert one["has_wikidata_enrichment"] and one["art_movements"] == ["Dada"]
    mine, theirs = (read_table(spark, x, "transformed_artworks").drop("transformed_at").collect() for x in (str(tmp_path / "w"), built[0]))
    assert sorted(mine, key=repr) == sorted(theirs, key=repr)
