"""Edge rows of the parsers and classifiers."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starhouse.functions import classify, dates, text
from starhouse.plans import artists, artworks


def column(spark, inputs, expression, kind="string"):
    rows = list(enumerate(inputs))
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", expression(F.col("v")).alias("r"))
    return [row["r"] for row in sorted(df.collect(), key=lambda row: row["i"])]


CREATION_DATES = [
    ("c. 1920", 1920, "circa"), ("ca. 1915-20", 1915, "circa"), ("c. unknown", None, "circa"),
    ("published 1922, printed 1930", 1922, "circa"), ("printed 1999", 1999, "circa"),
    ("c. 3050", 3050, "circa"), ("C. 1920", 1920, "exact"), ("early 1930s", 1930, "exact"),
    ("March 3, 1944", 1944, "exact"), ("May", None, "exact"), ("July 1944", 1944, "exact"),
    ("1920-1925", 1922, "range"), ("1921-1924", 1922, "range"), ("1920-25", 1920, "exact"),
    ("1920–1925", 1920, "exact"), ("1920 - 1925", 1920, "exact"), (" 1950 ", 1950, "exact"),
    (" 1950\t", 1950, "exact"), ("0999", None, "unknown"), ("2025", None, "unknown"),
    ("2024", 2024, "exact"), ("n.d.", None, "unknown"), ("", None, "unknown"), (None, None, "unknown"),
]


def test_creation_dates(spark):
    rows = [(i, raw) for i, (raw, _, _) in enumerate(CREATION_DATES)]
    df = artworks.with_creation_date(spark.createDataFrame(rows, "i int, date string"))
    got = {row["i"]: (row["creation_year"], row["date_certainty"]) for row in df.collect()}
    assert got == {i: (year, certainty) for i, (_, year, certainty) in enumerate(CREATION_DATES)}


DIMENSIONS = [
    ('12 x 8 1/2" (30.5 x 21.6 cm)', None, None, 30.5, 21.6),
    ("(30 x 20 x 10 cm)", None, None, 20.0, 10.0),
    ("5 cm", None, None, None, None),
    ("variable, cm", None, None, None, None),
    (None, None, None, None, None),
    ("(30 x 20 cm)", "40", None, 40.0, 20.0),
    ("10 x 12 CM", "n/a", None, 10.0, 12.0),
    ("line one\n3 x 4\ncm", None, None, 3.0, 4.0),
    ("cm 10 x 12 cm", None, None, 10.0, 12.0),
    ("10 x 12 in.", None, "7.5", None, 7.5),
    ("1 x 2 cm", "40d", "inf", 1.0, 2.0),
    ("1 x 2 cm", " 3 ", "1e1", 3.0, 10.0),
]


def test_dimensions(spark):
    rows = [(i, d, h, w) for i, (d, h, w, _, _) in enumerate(DIMENSIONS)]
    df = artworks.with_dimensions(spark.createDataFrame(rows, "i int, dimensions string, height_cm string, width_cm string"))
    got = {row["i"]: (row["height_cm"], row["width_cm"]) for row in df.collect()}
    assert got == {i: (height, width) for i, (_, _, _, height, width) in enumerate(DIMENSIONS)}


def test_long_dimension_text_is_read_whole(spark):
    long_text = "note " * 20_000 + "\n" + "x" * 50_000 + "\n 11 x 22 cm"
    df = spark.createDataFrame([(long_text, None, None)], "dimensions string, height_cm string, width_cm string")
    row = artworks.with_dimensions(df).first()
    assert (row["height_cm"], row["width_cm"]) == (11.0, 22.0)


def test_acquisition_dates(spark):
    assert column(spark, ["1996-04-09", "unknown", "1996", None], dates.iso_date) == [date(1996, 4, 9), None, None, None]


def test_acquisition_methods(spark):
    expected = {
        "Gift of X": "Gift", "Louis E. Stern Collection": "Gift", "Given anonymously": "Gift",
        "The Fund for the Twenty-First Century": "Gift", "Gift and purchase": "Purchase", "Purchased": "Purchase",
        "Bequest of Y": "Bequest", "Bequest of X (by exchange)": "Exchange", "Mrs. Z Fund": "Unknown", None: "Unknown",
    }
    assert column(spark, list(expected), classify.acquisition_method) == list(expected.values())


def test_true_flags(spark):
    flags = {"Y": True, "yes": True, "TRUE": True, "1": True, "N": False, " Y": False, None: False}
    assert column(spark, list(flags), text.is_true) == list(flags.values())


def test_life_years(spark):
    years = {
        "1923": 1923, "1923.0": 1923, "1923.7": 1923, " 1923 ": 1923, "0": None, "999": None, "1000": 1000, "2025": 2025,
        "2026": None, "abc": None, "None": None, "": None, None: None, "1e400": None, "99999999999": None,
    }
    assert column(spark, list(years), dates.life_year) == list(years.values())


def test_genders(spark):
    genders = {
        "M": "Male", " (Male) ": "Male", "f": "Female", "Non-Binary": "Non-binary", "Transgender Woman": "Non-binary",
        "other": "Unknown", "": "Unknown", "None": "Unknown", None: "Unknown",
    }
    assert column(spark, list(genders), classify.gender) == list(genders.values())


def test_life_spans(spark):
    df = artists.with_life(spark.createDataFrame(
        [("1900", "1980"), ("1900", None), (None, "1980")], "begin_date string, end_date string"
    ))
    assert [(r["is_living"], r["lifespan_years"]) for r in df.collect()] == [(False, 80), (True, None), (False, None)]


def test_calendar_parts(spark):
    years = [1999, 2000, 1905, None]
    assert column(spark, years, dates.decade, "int") == [1990, 2000, 1900, None]
    assert column(spark, years, dates.century, "int") == [19, 20, 19, None]
    assert column(spark, years, dates.date_key, "int") == [19990101, 20000101, 19050101, None]


def test_eras(spark):
    years = [1913, 1914, 1918, 1928, 1939, 1945, 1960, 1975, 1990, 2007, 2008, None]
    assert column(spark, years, dates.era, "int") == [
        "Gilded Age (rapid industrialisation & economic growth)", "WWI", "WWI", "Roaring Twenties", "Great Depression",
        "WWII", "Post-War Boom", "Cold War", "Postmodern", "Digital Age", "Contemporary", None,
    ]


def test_periods_and_events(spark):
    years = [1928, 1929, 1939, 1940, 2008, 2009, 2010]
    assert column(spark, years, dates.economic_period, "int") == [
        "Expansion", "Recession", "Recession", "Expansion", "Recession", "Recession", "Expansion",
    ]
    assert column(spark, [1987, 1988], dates.major_event, "int") == ["Black Monday stock market crash", None]


def test_nationalities(spark):
    expected = {
        "France": "french", "Austria": "austrian", "Yemen": "yemenian", "Niger": "nigerien",
        "Nationality unknown": "nationality unknownian", "a": "an",
    }
    assert column(spark, list(expected), classify.nationality) == list(expected.values())


@pytest.mark.parametrize(
    ("row", "score"),
    [
        (("t", "1920", date(1999, 1, 1), 1.0, 1.0, "Print", True), "1.00"),
        ((None, None, None, None, None, None, False), "0.00"),
        (("", "", None, 1.0, None, "(not assigned)", False), "0.00"),
        (("t", "n.d.", None, None, None, "", False), "0.55"),
    ],
)
def test_artwork_scores(spark, row, score):
    df = spark.createDataFrame([row], "t string, d string, a date, h double, w double, c string, f boolean")
    got = df.select(classify.artwork_score(*[F.col(name) for name in "tdahwcf"]).alias("s")).first()["s"]
    assert got == Decimal(score)


def test_artist_scores(spark):
    rows = [
        (1900, "French", "Male", "X", 1980, False, True),
        (None, None, "Unknown", "X", None, True, False),
        (None, "Unknown", "Unknown", "", 1980, False, False),
    ]
    df = spark.createDataFrame(rows, "b int, n string, g string, d string, e int, l boolean, r boolean")
    got = [row["s"] for row in df.select(classify.artist_score(*[F.col(name) for name in "bngdelr"]).alias("s")).collect()]
    assert got == [Decimal("1.00"), Decimal("0.25"), Decimal("0.10")]


def test_tiers(spark):
    scores = [Decimal("0.80"), Decimal("0.79"), Decimal("0.60"), Decimal("0.40"), Decimal("0.39")]
    assert column(spark, scores, classify.quality_tier, "decimal(3,2)") == [
        "Excellent (0.8-1.0)", "Good (0.6-0.8)", "Good (0.6-0.8)", "Fair (0.4-0.6)", "Poor (0.0-0.4)",
    ]
