"""Artists: cleaned years and gender, enrichment joined on, completeness scored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.functions import classify, dates, text
from starhouse.operators import rejects
from starhouse.operators.dedup import keep_first
from starhouse.operators.lookup import spread_nulls

STAGING_COLUMNS = ("constituent_id", "display_name", "nationality", "gender", "begin_date", "end_date", "wiki_qid")


def with_life(df: DataFrame) -> DataFrame:
    """Birth and death year, whether the artist lives (no death year), and the years between."""
    return df.withColumns({
        "birth_year": dates.life_year(F.col("begin_date")), "death_year": dates.life_year(F.col("end_date")),
    }).withColumns({
        "is_living": F.col("death_year").isNull(), "lifespan_years": F.col("death_year") - F.col("birth_year"),
    })


def with_enrichment(artists: DataFrame, enrichment: DataFrame) -> DataFrame:
    """Left join of the successful enrichment rows on the external id, with a flag."""
    found = enrichment.where("fetch_status = 'success'").select(
        "wikidata_id", F.col("movements").alias("art_movements"), "birth_place", "birth_place_country",
        "death_place", "education", "influenced_by",
    )
    key = spread_nulls(F.col("wiki_qid"), F.col("constituent_id"))
    return artists.join(found, key == F.col("wikidata_id"), "left").withColumn(
        "has_wikidata_enrichment", F.col("wikidata_id").isNotNull()
    )


def clean_artists(staging: DataFrame, keep_first_by: Sequence[str] | None = None) -> DataFrame:
    """Artists with typed id, cleaned years and gender, before any enrichment.

    Landed staging rows are already unique; give ``keep_first_by`` to drop repeated ids here too.
    """
    return rejects.accepted_rows(tagged_artists(staging, keep_first_by))


def tagged_artists(staging: DataFrame, keep_first_by: Sequence[str] | None = None) -> DataFrame:
    """Cleaned artists with their rejected values, and rows whose key is bad for the sake of theirs.

    A year that is empty or 0 is unknown, not bad.
    """
    source = staging.where(F.col("constituent_id").isNotNull()).select(
        *STAGING_COLUMNS, text.to_integer(F.col("constituent_id")).alias("artist_id"))
    if keep_first_by is not None:
        source = keep_first(source, ["constituent_id"], keep_first_by)
    cleaned = with_life(source).withColumn("gender_clean", classify.gender(F.col("gender")))

    def year(raw: str, parsed: str) -> tuple[str, Column, Column, str]:
        given = text.strip(F.col(raw))
        return raw, F.col(raw), given.isNotNull() & ~given.isin("", "0") & F.col(parsed).isNull(), rejects.NO_YEAR

    bad_key = ("constituent_id", F.col("constituent_id"), F.col("artist_id").isNull(), rejects.BAD_KEY)
    checks = [bad_key, year("begin_date", "birth_year"), year("end_date", "death_year")]
    return rejects.tagged(cleaned, F.col("artist_id").isNotNull(), F.col("constituent_id"), checks)


def transform_artists(
    staging: DataFrame, enrichment: DataFrame, keep_first_by: Sequence[str] | None = None, quarantine: bool = False
) -> DataFrame:
    """Cleaned artists with their enrichment and completeness score; with ``quarantine``, tagged for their write."""
    cleaned = tagged_artists(staging, keep_first_by) if quarantine else clean_artists(staging, keep_first_by)
    enriched = with_enrichment(cleaned, enrichment)
    score = classify.artist_score(
        F.col("birth_year"), F.col("nationality"), F.col("gender_clean"), F.col("display_name"),
        F.col("death_year"), F.col("is_living"), F.col("has_wikidata_enrichment"),
    )
    return enriched.select(
        "artist_id", "display_name", "birth_year", "death_year", "is_living", "lifespan_years", "nationality",
        "gender_clean", "wikidata_id", "has_wikidata_enrichment", "art_movements", "birth_place", "birth_place_country",
        "death_place", "education", "influenced_by",
        score.alias("data_quality_score"),
        F.current_timestamp().alias("transformed_at"),
        *([rejects.ACCEPTED, rejects.KEY, rejects.REJECTED] if quarantine else []),
    )
