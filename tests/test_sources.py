"""Readers and writers on files."""

from __future__ import annotations

import json
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from starhouse import rules
from starhouse.operators import dealing
from starhouse.sources import csv as csv_source
from starhouse.sources import json as json_source
from starhouse.sources import tables

ARTISTS_CSV = (
    "ConstituentID,DisplayName,ArtistBio,Nationality,Gender,BeginDate,EndDate,Wiki QID,ULAN\n"
    '1,"Smith, ""Jo""","two\nlines",French,Male,1900,1980,Q1,500\n'
    "2,None,n/a,Austrian,,1950,0,,\n"
    "1,Copy,,,,,,,\n"
    ",No key,,,,,,,\n"
    "3, padded ,NaN,Unknown,female,abc,,Q3,\n"
)


def test_artists_land_as_text_once_per_key(spark, tmp_path):
    path = tmp_path / "Artists.csv"
    path.write_text(ARTISTS_CSV)
    landed = csv_source.land_artists(spark, str(path))
    rows = {row["constituent_id"]: row for row in landed.collect()}
    assert set(rows) == {"1", "2", "3"}
    assert rows["1"]["display_name"] == 'Smith, "Jo"' and rows["1"]["artist_bio"] == "two\nlines"
    assert rows["2"]["display_name"] is None and rows["2"]["artist_bio"] is None and rows["2"]["end_date"] == "0"
    assert rows["3"]["display_name"] == " padded " and rows["3"]["source_file"] == "Artists.csv"
    assert dict(landed.dtypes)["ulan"] == "string" and dict(landed.dtypes)["loaded_at"] == "timestamp"


def test_missing_columns_land_empty(spark, tmp_path):
    path = tmp_path / "Artworks.csv"
    path.write_text("ObjectID,Title,Height (cm)\n7,Thing,12.0\n")
    row = csv_source.land_artworks(spark, str(path)).first()
    assert (row["object_id"], row["title"], row["height_cm"], row["width_cm"]) == ("7", "Thing", "12.0", None)
    assert set(rules.ARTWORK_HEADERS.values()) <= set(row.asDict())


def test_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ObjectID,Title\n1,x\n")
    (tmp_path / "b.csv").write_text("Title,ObjectID\ny,2\n")
    with pytest.raises(Exception, match="header"):
        csv_source.land_artworks(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("block", [64, 1000, 10**8])
def test_split_reading_equals_whole_reading(spark, tmp_path, newline, block):
    names = ["ObjectID", "Title", "Medium"]
    lines = [",".join(names)]
    for n in range(300):
        title = f'"He said ""no"" {n}{newline}{newline}second, line{newline}third"' if n % 3 == 0 else f"plain {n}"
        lines.append(f"{n},{title},{'' if n % 5 == 0 else 'ink'}")
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text(newline.join(lines) + newline, newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        split = csv_source.read_big_csv_text(spark, str(tmp_path), names).cache()
        whole = csv_source.read_csv_text(spark, str(tmp_path))
        assert values(split, *names, "source_file") == values(whole, *names, "source_file")
        ordered = split.where("source_file = 'a.csv'").orderBy(csv_source.LANDING_ORDER).select("ObjectID").collect()
        assert [int(row[0]) for row in ordered] == list(range(300))
        split.unpersist()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(("text", "message"), [
    ("Title,ObjectID\nBoat,1\n", "other columns"), ("ObjectID,Title,Medium\n1,Boat,ink\n", "other columns"),
    ('ObjectID,Title\n1,"Boat\n2,Tree\n', "does not end"), ("ObjectID\n1\n", "other columns"),
    ('ObjectID,Title\n1,8 1/2" print\n2,a\n3,b\n4,9" frame\n5,c\n', "unquoted field"), ('ObjectID,Title\n1,"a" b\n', "unquoted field"),
    ('ObjectID,Title\n1, "a"\n', "unquoted field"), ('ObjectID,Title\n1,"a\n2,b\n3,"c\n', "unquoted field"),
])
def test_split_reading_refuses_other_headers_and_open_quotes(spark, tmp_path, text, message):
    (tmp_path / "a.csv").write_text(text)
    with pytest.raises(Exception, match=message):
        csv_source.read_big_csv_text(spark, str(tmp_path), ["ObjectID", "Title"]).collect()


def test_split_reading_holds_a_bounded_number_of_lines(spark, tmp_path, monkeypatch):
    """One block of a file is read as a single one, yet no task gathers it, and quotes run on from chunk to chunk."""
    monkeypatch.setattr(dealing, "TASK_ROWS", 100)
    monkeypatch.setattr(csv_source, "CHUNK_LINES", 16)
    lines = ["ObjectID,Title", *[f'{n},"a\n""b"", line\n\n{n}"' if n % 3 == 0 else f"{n},plain" for n in range(2000)], '2000,"' + "x\n" * 70 + '"']
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    split = csv_source.read_big_csv_text(spark, str(tmp_path), ["ObjectID", "Title"]).cache()
    whole = csv_source.read_csv_text(spark, str(tmp_path))
    assert values(split, "ObjectID", "Title", "source_file") == values(whole, "ObjectID", "Title", "source_file")
    ordered = split.where("source_file = 'b.csv'").orderBy(csv_source.LANDING_ORDER).select("ObjectID").collect()
    assert [int(row[0]) for row in ordered] == list(range(2001))
    assert split.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 300
    assert split._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") >= 2
    split.unpersist()


def test_split_reading_equals_whole_reading_or_stops(spark, tmp_path):
    """Random files of all kinds of fields: either both readers agree, or the splitting one stops and says why."""
    rng = random.Random(12)
    fields = ["", "a", '""', '"a"', '"a,b"', '"x ""y"" z"', '"two\nlines"', '"\n"', 'in""side', '""""', " ", '" "']
    stray = ['8" x', '"a" b', ' "a"', 'x"y"', '"open']
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    stopped = 0
    try:
        for n in range(24):
            rows = [[str(k), rng.choice(fields), rng.choice(fields)] for k in range(40)]
            if n % 3 == 0:
                for k in rng.sample(range(40), 2):
                    rows[k][rng.choice([1, 2])] = rng.choice(stray)
            path = tmp_path / f"{n}.csv"
            path.write_text("ObjectID,Title,Medium\n" + "\n".join(map(",".join, rows)) + "\n")
            try:
                split = values(csv_source.read_big_csv_text(spark, str(path), ["ObjectID", "Title", "Medium"]), "ObjectID", "Title", "Medium")
            except Exception as error:
                assert n % 3 == 0 and ("unquoted field" in str(error) or "does not end" in str(error))
                stopped += 1
            else:
                assert split == values(csv_source.read_csv_text(spark, str(path)), "ObjectID", "Title", "Medium"), path.read_text()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert stopped >= 6


COUNTRIES = [
    {"name": {"common": " France "}, "cca2": "FR", "cca3": "FRA", "region": "Europe", "subregion": "Western Europe",
     "continents": ["Europe", "Other"], "latlng": [46.0, 2.0]},
    {"name": {"common": "Austria"}, "cca2": "AT", "region": "Europe", "latlng": [47.5]},
    {"name": {"common": ""}, "cca2": "ZZ"},
    {"cca2": "YY"},
    {"name": {"common": "Zweitland"}, "cca2": "FR"},
]


def test_countries_flatten(spark, tmp_path):
    (tmp_path / "all.json").write_text(json.dumps(COUNTRIES, indent=1))
    flat = json_source.flatten_countries(json_source.read_documents(spark, str(tmp_path), "name"))
    assert values(flat, "country_name", "country_code_iso2", "country_code_iso3", "continent", "subregion", "latitude", "longitude") == [
        ("Austria", "AT", "", "", "", 47.5, None), ("France", "FR", "FRA", "Europe", "Western Europe", 46.0, 2.0),
        ("Zweitland", "FR", "", "", "", None, None),
    ]
    reference = json_source.geography_reference(flat)
    assert values(reference, "country_code_iso2", "nationality", "source") == [
        ("AT", "austrian", rules.COUNTRY_SOURCE), ("FR", "french", rules.COUNTRY_SOURCE),
        ("XX", "nationality unknownian", "Custom mapping"),
    ]


def test_tables_conform_and_report_rejects(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "12.345", "1999-01-01"), ("x", "1e12", "never"), ("3", None, None)],
        "artwork_id string, height_cm string, date_acquired string",
    )
    written = tables.write_table(df, str(tmp_path), "transformed_artworks")
    assert written.rows == 3 and written.rejected == {"artwork_id": 1, "height_cm": 1, "date_acquired": 1}
    back = tables.read_table(spark, str(tmp_path), "transformed_artworks")
    assert dict(back.dtypes)["height_cm"] == "decimal(10,2)" and str(back.where("artwork_id = 1").first()["height_cm"]) == "12.35"
    counts = {row["column_name"]: row["rejected"] for row in tables.rejected_values(df, "transformed_artworks").collect()}
    assert counts == {"artwork_id": 1, "height_cm": 1, "date_acquired": 1}
    again = tables.write_table(df.where("artwork_id = '1'"), str(tmp_path), "transformed_artworks")
    assert again.rows == 1


def test_empty_table_is_written(spark, tmp_path):
    nothing = spark.range(10).where(F.lit(False)).select(F.col("id").alias("batch_no"))
    written = tables.write_table(nothing, str(tmp_path), "staging_requests")
    assert written.rows == 0 and written.rejected == {}
    assert tables.read_table(spark, str(tmp_path), "staging_requests").columns == ["artist_name", "wikidata_id", "batch_no"]


def test_projection_and_filter_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.lit("x").alias("wide"), F.col("id").alias("other")).write.parquet(path)
    plan = tables.project_filter(spark.read.parquet(path), ["id"], "other")._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(other)" in plan and "wide" not in plan
