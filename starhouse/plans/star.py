"""Dimensions and facts of the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse import rules, schemas
from starhouse.functions import dates
from starhouse.functions.text import equals_ignoring_case
from starhouse.operators.dealing import dealt
from starhouse.operators.lookup import with_calendar_value
from starhouse.operators.numbering import composite_key


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", F.current_timestamp())


def _columns(table: str) -> list[str]:
    return [name for name in schemas.DIMENSIONAL[table] if name not in schemas.LOAD_STAMPS]


def dim_date(date_economics: DataFrame) -> DataFrame:
    return _stamped(date_economics.select(*_columns("dim_date")))


def dim_geography(geography: DataFrame) -> DataFrame:
    return _stamped(geography.select(*_columns("dim_geography")))


def dim_artist(artists: DataFrame) -> DataFrame:
    """Artists with the unknown member ahead of them; nationality in lower case, not trimmed."""
    known = artists.select(
        "*", F.col("gender_clean").alias("gender"), F.col("total_artworks_in_collection").alias("total_artworks")
    ).withColumn("nationality", F.lower("nationality")).select(*_columns("dim_artist"))
    values = {
        "artist_id": rules.UNKNOWN_ARTIST_ID, "display_name": rules.UNKNOWN_ARTIST_NAME, "total_artworks": 0,
        "data_quality_score": 0, "has_wikidata_enrichment": False,
    }
    unknown = artists.sparkSession.range(1).select(
        *[F.lit(values.get(field.name)).cast(field.dataType).alias(field.name) for field in known.schema]
    )
    return _stamped(unknown.unionByName(known))


def dim_artwork(artworks: DataFrame) -> DataFrame:
    year = F.col("creation_year")
    return _stamped(
        artworks.withColumns({"creation_decade": dates.decade(year), "creation_century": dates.century(year)})
        .select(*_columns("dim_artwork"))
    )


def fact_artwork_acquisitions(
    artworks: DataFrame, bridge: DataFrame, artists: DataFrame, dates_dim: DataFrame, tasks: int | None = None
) -> DataFrame:
    """One row per artwork and artist; artworks without an artist point to the unknown member.

    Works with and without links are handled apart and united.  As one left join, the rows of a
    work with very many links could not be split over tasks, and all unlinked works would meet the
    artists under one empty key.  As two, the inner join splits and unlinked works skip the artists.
    Works meet links in ``tasks`` partitions (:mod:`dealing`).
    """
    works = artworks.select(
        "artwork_id", "acquisition_year", "creation_year", "accession_number", "acquisition_method", "cataloged"
    ).where(F.col("artwork_id").isNotNull())  # both joins below read the same plan, and so one shuffle of the works
    works = dealt(works, tasks, "artwork_id")
    links = bridge.select("artwork_id", F.col("artist_id").alias("_linked_artist"))
    people = artists.select(
        "artist_id", "nationality", "is_living", (F.col("gender_clean") == "Female").alias("_female")
    )
    linked = works.join(links, "artwork_id").join(people, F.col("_linked_artist") == F.col("artist_id"), "left").drop("_linked_artist")
    unlinked = works.join(links.select("artwork_id").distinct(), "artwork_id", "left_anti").select(
        "*", *[F.lit(None).cast(field.dataType).alias(field.name) for field in people.schema]
    )
    both = linked.unionByName(unlinked)
    dated = with_calendar_value(both, F.col("acquisition_year"), dates_dim, "year", "date_key", "acquisition_date_key")
    dated = with_calendar_value(dated, F.col("creation_year"), dates_dim, "year", "date_key", "creation_date_key")
    artist = F.coalesce("artist_id", F.lit(rules.UNKNOWN_ARTIST_ID))
    gap = F.col("acquisition_year") - F.col("creation_year")

    def method(name: str) -> Column:
        return equals_ignoring_case(F.col("acquisition_method"), name)

    return _stamped(dated.select(
        composite_key(F.col("artwork_id"), artist).alias("acquisition_key"),
        "artwork_id", artist.alias("artist_id"), "acquisition_date_key", "creation_date_key",
        "nationality", "accession_number",
        F.when(gap < 0, 0).otherwise(gap).alias("years_from_creation_to_acquisition"),
        method("gift").alias("is_gift"), method("purchase").alias("is_purchase"), method("bequest").alias("is_bequest"),
        F.col("is_living").alias("is_living_artist_at_acquisition"),
        F.coalesce(gap <= rules.CONTEMPORARY_YEARS, F.lit(False)).alias("is_contemporary"),
        F.col("cataloged").alias("is_cataloged"),
        F.coalesce("_female", F.lit(False)).alias("is_female_artist"),
    ))


def fact_artist_summary(
    artist_dim: DataFrame, acquisitions: DataFrame, artwork_dim: DataFrame, dates_dim: DataFrame,
    snapshot_date: date | None = None, tasks: int | None = None,
) -> DataFrame:
    """One row per artist of the dimension, with figures over the artist's acquisitions.

    Acquisitions are reduced to one row per artist before they meet the dimension, so a prolific
    artist, or the unknown member, is combined where its rows lie.  Each pair of artwork and
    artist is one acquisition, so counting rows counts works.  Acquisitions meet works in ``tasks``
    partitions (:mod:`dealing`).
    """
    snapshot = F.current_date() if snapshot_date is None else F.lit(snapshot_date)
    works = artwork_dim.select("artwork_id", "creation_year", F.lit(True).alias("_work"))
    rows = acquisitions.select("artwork_id", "artist_id", "acquisition_date_key", "years_from_creation_to_acquisition")
    rows = dealt(rows, tasks, "artwork_id").join(dealt(works, tasks, "artwork_id"), "artwork_id", "left")
    rows = with_calendar_value(rows, F.col("acquisition_date_key"), dates_dim, "date_key", "year", "acquisition_year")
    recent = F.year(snapshot) - F.col("creation_year") <= rules.CONTEMPORARY_YEARS
    figures = rows.groupBy("artist_id").agg(
        F.count("_work").cast("int").alias("total_artworks"),
        F.min("acquisition_year").alias("first_acquisition_year"),
        F.max("acquisition_year").alias("last_acquisition_year"),
        F.min("creation_year").alias("earliest_artwork_year"),
        F.max("creation_year").alias("latest_artwork_year"),
        F.round(F.avg("years_from_creation_to_acquisition"), 0).alias("avg_years_to_acquisition"),
        F.max(recent).alias("_has_recent"),
    )
    day = F.date_format(snapshot, "yyyyMMdd").cast("int")
    return _stamped(
        artist_dim.select("artist_id", "nationality").join(figures, "artist_id", "left").select(
            composite_key(F.col("artist_id"), day).alias("artist_summary_key"),
            "artist_id", "nationality", snapshot.alias("snapshot_date"),
            F.coalesce("total_artworks", F.lit(0)).alias("total_artworks"),
            "first_acquisition_year", "last_acquisition_year",
            (F.col("last_acquisition_year") - F.col("first_acquisition_year")).alias("span_of_acquisitions_years"),
            "earliest_artwork_year", "latest_artwork_year", "avg_years_to_acquisition",
            F.coalesce("_has_recent", F.lit(False)).alias("has_contemporary_works"),
        )
    )


def movement_counts(artist_dim: DataFrame) -> DataFrame:
    """Artists per art movement."""
    return artist_dim.select(F.explode("art_movements").alias("movement")).groupBy("movement").agg(F.count("*").alias("artists"))
