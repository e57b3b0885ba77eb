"""The many-to-many link between artworks and artists, and what is derived from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.functions.text import to_integer
from starhouse.operators import rejects
from starhouse.operators.dealing import dealt


def listed_artists(staging_artworks: DataFrame) -> DataFrame:
    """``artwork_id, listed_id`` (text): the delimited id list of every work as rows."""
    return staging_artworks.where(F.col("constituent_id") != "").select(
        to_integer(F.col("object_id")).alias("artwork_id"),
        F.explode(F.split("constituent_id", ",")).alias("listed_id"),
    ).where(F.col("artwork_id").isNotNull())


def bad_artist_ids(staging_artworks: DataFrame) -> DataFrame:
    """Listed ids that are no whole number: kept out of the bridge and reported here."""
    return listed_artists(staging_artworks).where(to_integer(F.col("listed_id")).isNull())


def build_bridge(
    staging_artworks: DataFrame, artists: DataFrame, artworks: DataFrame | None = None, carry: Sequence[str] = (),
    tasks: int | None = None,
) -> DataFrame:
    """``artwork_id, artist_id, artists_total`` with one row per pair.

    A work's whole list sits in one staging row, so counting the listed ids and removing repeated
    ones happen on the array, before it becomes rows: neither needs a shuffle.  ``artists_total``
    counts every listed id, also the repeated ones and those of unknown artists, which then drop out.

    ``artworks`` restricts the works; leave it out when it was made from the same staging rows.  Its columns
    ``carry`` come along, which saves :func:`artist_stats` a second join.  That join is made in ``tasks`` partitions (:mod:`dealing`).
    """
    ids = F.filter(
        F.transform(F.split("constituent_id", ","), to_integer),
        lambda listed: listed.isNotNull(),
    )
    works = (
        staging_artworks.where(F.col("constituent_id") != "")
        .select(to_integer(F.col("object_id")).alias("artwork_id"), ids.alias("_ids"))
        .where(F.col("artwork_id").isNotNull())
    )
    if artworks is not None:
        kept = artworks.select("artwork_id", *carry)
        works = dealt(works, tasks, "artwork_id").join(dealt(kept, tasks, "artwork_id"), "artwork_id")
    pairs = works.select(
        "artwork_id", F.explode(F.array_distinct("_ids")).alias("artist_id"), F.size("_ids").alias("artists_total"), *carry
    )
    known = pairs.join(artists.select("artist_id"), "artist_id", "left_semi")
    return known.select("artwork_id", "artist_id", "artists_total", *carry)


def tagged_bridge(staging_artworks: DataFrame, artists: DataFrame) -> DataFrame:
    """The bridge with the listed ids that it leaves out: no whole numbers, or of no artist.

    Every distinct id of a work is one row, good or bad, so that one pass tells them apart.
    """
    listed = F.split("constituent_id", ",")
    works = staging_artworks.where(F.col("constituent_id") != "").select(
        to_integer(F.col("object_id")).alias("artwork_id"), listed.alias("_listed"),
        F.size(F.filter(F.transform(listed, to_integer), lambda x: x.isNotNull())).alias("artists_total"),
    ).where(F.col("artwork_id").isNotNull())
    ids = works.select("artwork_id", "artists_total", F.explode(F.array_distinct(F.transform(
        "_listed", lambda x: F.struct(to_integer(x).alias("id"), F.when(to_integer(x).isNull(), x).alias("raw"))))).alias("e"))
    known = artists.select("artist_id", F.lit(True).alias("_known"))
    met = ids.select("artwork_id", F.col("e.id").alias("artist_id"), F.col("e.raw").alias("_raw"), "artists_total").join(known, "artist_id", "left")
    raw, no_number = F.coalesce("_raw", F.col("artist_id").cast("string")), F.col("artist_id").isNull()
    return rejects.tagged(met, F.col("_known").isNotNull(), F.col("artwork_id"), [
        ("constituent_id", raw, no_number, rejects.BAD_LIST_ID),
        ("constituent_id", raw, ~no_number & F.col("_known").isNull(), rejects.UNKNOWN_ARTIST),
    ]).drop("_raw", "_known")


def artist_stats(bridge: DataFrame, artworks: DataFrame | None = None) -> DataFrame:
    """Works and acquisition years per artist; the bridge holds each pair once, so rows are works.

    ``artworks`` may be left out if the bridge carries ``acquisition_year``.
    """
    dated = bridge if artworks is None else bridge.select("artwork_id", "artist_id").join(
        artworks.select("artwork_id", "acquisition_year"), "artwork_id", "left"
    )
    return dated.groupBy("artist_id").agg(
        F.count("*").cast("int").alias("total_artworks_in_collection"),
        F.min("acquisition_year").alias("first_acquisition_year"),
        F.max("acquisition_year").alias("last_acquisition_year"),
    )


def with_artist_stats(artists: DataFrame, bridge: DataFrame, artworks: DataFrame | None = None) -> DataFrame:
    """Artists with their statistics filled in; replaces columns of the same name."""
    stats = artist_stats(bridge, artworks)
    bare = artists.drop(*[name for name in stats.columns if name != "artist_id"])
    joined = bare.join(stats, "artist_id", "left")
    return joined.withColumn(
        "total_artworks_in_collection", F.coalesce("total_artworks_in_collection", F.lit(0))
    )
