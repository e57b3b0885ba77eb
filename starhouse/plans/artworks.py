"""Artworks: one projection over the staging rows, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.functions import classify, dates, measures, text
from starhouse.operators import rejects

STAGING_COLUMNS = (
    "object_id", "title", "date", "medium", "dimensions", "credit_line", "accession_number", "classification",
    "department", "date_acquired", "cataloged", "url", "image_url", "height_cm", "width_cm",
)


def with_creation_date(df: DataFrame, raw: str = "date") -> DataFrame:
    """Add ``creation_year`` and ``date_certainty``; each regular expression runs once per row."""
    return (
        df.withColumn("_text", dates.date_text(F.col(raw)))
        .withColumn("_runs", dates.year_runs(F.col("_text")))
        .withColumn("_parsed", dates.creation_date(F.col("_text"), F.col("_runs")))
        .withColumns({"creation_year": F.col("_parsed.creation_year"), "date_certainty": F.col("_parsed.date_certainty")})
        .drop("_text", "_runs", "_parsed")
    )


def with_dimensions(df: DataFrame) -> DataFrame:
    """Numeric height and width; where one is missing it is read from the description.

    The description is only searched on rows that need it.
    """
    height, width, numbers = F.col("height_cm"), F.col("width_cm"), F.col("_numbers")
    return (
        df.withColumns({"height_cm": text.to_number(height), "width_cm": text.to_number(width)})
        .withColumn("_numbers", F.when(height.isNull() | width.isNull(), measures.numbers_before_cm(F.col("dimensions"))))
        .withColumns({
            "height_cm": F.coalesce(height, measures.described_measure(numbers, 2)),
            "width_cm": F.coalesce(width, measures.described_measure(numbers, 1)),
        })
        .drop("_numbers")
    )


def with_acquisition_date(df: DataFrame) -> DataFrame:
    return df.withColumn("date_acquired", dates.iso_date(F.col("date_acquired"))).withColumn(
        "acquisition_year", F.year("date_acquired")
    )


def transform_artworks(staging: DataFrame) -> DataFrame:
    """Cleaned artworks.  A width read from a three-part description is its last part."""
    return rejects.accepted_rows(tagged_artworks(staging))


def tagged_artworks(staging: DataFrame) -> DataFrame:
    """Cleaned artworks with their rejected values, and rows whose key is bad for the sake of theirs."""
    raw = {f"_raw_{name}": F.col(name) for name in ("object_id", "height_cm", "width_cm", "date_acquired")}
    source = staging.where(F.col("object_id").isNotNull()).select(*STAGING_COLUMNS).withColumns(raw)
    parsed = with_acquisition_date(with_dimensions(with_creation_date(source))).withColumn(
        "cataloged", text.is_true(F.col("cataloged"))
    )
    score = classify.artwork_score(
        F.col("title"), F.col("date"), F.col("date_acquired"), F.col("height_cm"), F.col("width_cm"),
        F.col("classification"), F.col("cataloged"),
    )
    cleaned = parsed.select(
        text.to_integer(F.col("object_id")).alias("artwork_id"),
        "title", "creation_year", F.col("date").alias("creation_date_raw"), "date_certainty",
        "medium", "classification", "department", "height_cm", "width_cm",
        F.lit(None).cast("double").alias("depth_cm"),
        F.col("dimensions").alias("dimensions_text"), "date_acquired", "acquisition_year", "credit_line",
        classify.acquisition_method(F.col("credit_line")).alias("acquisition_method"),
        "accession_number", "cataloged", F.col("url").alias("museum_url"), "image_url",
        score.alias("data_quality_score"),
        F.current_timestamp().alias("transformed_at"),
        *raw,
    )

    def check(name: str, parsed_to: Column, reason: str) -> tuple[str, Column, Column, str]:
        given = F.col(f"_raw_{name}")
        return name, given, given.isNotNull() & parsed_to.isNull(), reason

    numbers = [check(name, text.to_number(F.col(f"_raw_{name}")), rejects.NO_NUMBER) for name in ("height_cm", "width_cm")]
    checks = [check("object_id", F.col("artwork_id"), rejects.BAD_KEY), *numbers, check("date_acquired", F.col("date_acquired"), rejects.NO_DATE)]
    return rejects.tagged(cleaned, F.col("artwork_id").isNotNull(), F.col("_raw_object_id"), checks).drop(*raw)
