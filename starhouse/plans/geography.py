"""Countries with the number of their artists and artworks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.functions.text import strip
from starhouse.operators.dealing import dealt


def transform_geography(
    reference: DataFrame, artists: DataFrame, bridge: DataFrame, artworks: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Geography reference left-joined with counts per normalised nationality.

    Counts are reduced to one row per nationality before they meet the reference.  The bridge only
    holds existing artworks; pass ``artworks`` to check that against another artwork table, in ``tasks``
    partitions (:mod:`dealing`).
    """
    nationality = F.lower(F.trim("nationality")).alias("nationality")
    named = artists.where(F.col("nationality").isNotNull()).select("artist_id", nationality)
    artist_counts = named.groupBy("nationality").agg(F.count_distinct("artist_id").cast("int").alias("total_artists"))
    works = bridge.select("artwork_id", "artist_id")
    if artworks is not None:
        works = works.join(dealt(artworks.select("artwork_id"), tasks, "artwork_id"), "artwork_id", "left_semi")
    artwork_counts = (
        works.join(named, "artist_id")
        .groupBy("nationality")
        .agg(F.count_distinct("artwork_id").cast("int").alias("total_artworks"))
    )
    countries = reference.where(F.col("country_name").isNotNull()).withColumn(
        "nationality", strip(F.lower("nationality"))
    )
    return (
        countries.join(artist_counts, "nationality", "left")
        .join(artwork_counts, "nationality", "left")
        .select(
            "nationality", "country_name", "country_code_iso2", "country_code_iso3", "continent", "region",
            "subregion", "latitude", "longitude",
            F.coalesce("total_artists", F.lit(0)).alias("total_artists"),
            F.coalesce("total_artworks", F.lit(0)).alias("total_artworks"),
            F.current_timestamp().alias("created_at"),
        )
    )
