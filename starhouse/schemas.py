"""Column types, keys and references of every warehouse table."""

from __future__ import annotations

from starhouse.rules import ARTIST_HEADERS, ARTWORK_HEADERS

# Columns and types of the tables must be as they are.
_LANDED = {"source_file": "string", "loaded_at": "timestamp"}

STAGING = {
    "staging_artworks": {name: "string" for name in ARTWORK_HEADERS.values()} | _LANDED,
    "staging_artists": {name: "string" for name in ARTIST_HEADERS.values()} | _LANDED,
    "staging_requests": {"artist_name": "string", "wikidata_id": "string", "batch_no": "bigint"},
    "staging_enrichment": {
        "artist_name": "string", "wikidata_id": "string", "movements": "array<string>",
        "bio_text": "string", "birth_place": "string", "birth_place_country": "string",
        "death_place": "string", "education": "string", "influenced_by": "array<string>",
        "batch_no": "bigint", "fetched_at": "timestamp", "fetch_status": "string",
    },
    "staging_responses": {"batch_no": "bigint", "api_response_json": "string"},
    "staging_geography": {
        "country_name": "string", "country_code_iso2": "string", "country_code_iso3": "string",
        "continent": "string", "region": "string", "subregion": "string",
        "latitude": "decimal(9,6)", "longitude": "decimal(9,6)", "nationality": "string",
        "loaded_at": "timestamp", "source": "string",
    },
    "staging_economics": {
        "year": "int", "gdp_usd_billions": "decimal(12,2)", "inflation_rate_percent": "decimal(5,2)",
        "unemployment_rate_percent": "decimal(5,2)", "sp500_close": "decimal(10,2)",
        "major_events": "string", "economic_period": "string", "loaded_at": "timestamp",
        "source": "string",
    },
}

TRANSFORMED = {
    "transformed_artworks": {
        "artwork_id": "int", "title": "string", "creation_year": "int", "creation_date_raw": "string",
        "date_certainty": "string", "medium": "string", "classification": "string",
        "department": "string", "height_cm": "decimal(10,2)", "width_cm": "decimal(10,2)",
        "depth_cm": "decimal(10,2)", "dimensions_text": "string", "date_acquired": "date",
        "acquisition_year": "int", "credit_line": "string", "acquisition_method": "string",
        "accession_number": "string", "cataloged": "boolean", "museum_url": "string",
        "image_url": "string", "data_quality_score": "decimal(3,2)", "transformed_at": "timestamp",
    },
    "transformed_artists": {
        "artist_id": "int", "display_name": "string", "birth_year": "int", "death_year": "int",
        "is_living": "boolean", "lifespan_years": "int", "nationality": "string",
        "gender_clean": "string", "wikidata_id": "string", "has_wikidata_enrichment": "boolean",
        "art_movements": "array<string>", "birth_place": "string", "birth_place_country": "string",
        "death_place": "string", "education": "string", "influenced_by": "array<string>",
        "total_artworks_in_collection": "int", "first_acquisition_year": "int",
        "last_acquisition_year": "int", "data_quality_score": "decimal(3,2)",
        "transformed_at": "timestamp",
    },
    "bridge_artwork_artist": {"artwork_id": "int", "artist_id": "int", "artists_total": "int"},
    "transformed_geography": {
        "nationality": "string", "country_name": "string", "country_code_iso2": "string",
        "country_code_iso3": "string", "continent": "string", "region": "string",
        "subregion": "string", "latitude": "decimal(9,6)", "longitude": "decimal(9,6)",
        "total_artists": "int", "total_artworks": "int", "created_at": "timestamp",
    },
    "transformed_date_economics": {
        "date_key": "int", "full_date": "date", "year": "int", "decade": "int", "century": "int",
        "era": "string", "gdp_usd_billions": "decimal(12,2)", "inflation_rate_percent": "decimal(5,2)",
        "unemployment_rate_percent": "decimal(5,2)", "sp500_close": "decimal(10,2)",
        "economic_period": "string", "major_events": "string", "created_at": "timestamp",
    },
}

DIMENSIONAL = {
    "dim_date": TRANSFORMED["transformed_date_economics"],
    "dim_geography": TRANSFORMED["transformed_geography"],
    "dim_artist": {
        "artist_id": "int", "display_name": "string", "birth_year": "int", "death_year": "int",
        "is_living": "boolean", "lifespan_years": "int", "nationality": "string",
        "birth_place": "string", "death_place": "string", "gender": "string",
        "wikidata_id": "string", "art_movements": "array<string>", "education": "string",
        "influenced_by": "array<string>", "total_artworks": "int", "first_acquisition_year": "int",
        "last_acquisition_year": "int", "data_quality_score": "decimal(3,2)",
        "has_wikidata_enrichment": "boolean", "created_at": "timestamp",
    },
    "dim_artwork": {
        "artwork_id": "int", "title": "string", "accession_number": "string", "medium": "string",
        "classification": "string", "department": "string", "height_cm": "decimal(10,2)",
        "width_cm": "decimal(10,2)", "depth_cm": "decimal(10,2)", "dimensions_text": "string",
        "creation_year": "int", "creation_date_raw": "string", "date_certainty": "string",
        "creation_decade": "int", "creation_century": "int", "acquisition_method": "string",
        "credit_line": "string", "cataloged": "boolean", "museum_url": "string",
        "image_url": "string", "data_quality_score": "decimal(3,2)", "created_at": "timestamp",
    },
    "fact_artwork_acquisitions": {
        "acquisition_key": "bigint", "artwork_id": "int", "artist_id": "int",
        "acquisition_date_key": "int", "creation_date_key": "int", "nationality": "string",
        "accession_number": "string", "years_from_creation_to_acquisition": "int",
        "is_gift": "boolean", "is_purchase": "boolean", "is_bequest": "boolean",
        "is_living_artist_at_acquisition": "boolean", "is_contemporary": "boolean",
        "is_cataloged": "boolean", "is_female_artist": "boolean", "created_at": "timestamp",
    },
    "fact_artist_summary": {
        "artist_summary_key": "bigint", "artist_id": "int", "nationality": "string",
        "snapshot_date": "date", "total_artworks": "int", "first_acquisition_year": "int",
        "last_acquisition_year": "int", "span_of_acquisitions_years": "int",
        "earliest_artwork_year": "int", "latest_artwork_year": "int",
        "avg_years_to_acquisition": "decimal(5,2)", "has_contemporary_works": "boolean",
        "created_at": "timestamp",
    },
}

LAYERS = {"staging": STAGING, "transformed": TRANSFORMED, "dimensional": DIMENSIONAL}
TABLES = STAGING | TRANSFORMED | DIMENSIONAL

# Tables whose writes keep rejected values beside the accepted rows.
QUARANTINED = frozenset({"transformed_artworks", "transformed_artists", "bridge_artwork_artist"})

# Columns that stamp the load itself; value comparisons leave them out.
LOAD_STAMPS = ("loaded_at", "fetched_at", "transformed_at", "created_at")

UNIQUE_KEYS = {
    "staging_artworks": [("object_id",)],
    "staging_artists": [("constituent_id",)],
    "staging_requests": [("wikidata_id",)],
    "staging_enrichment": [("wikidata_id",)],
    "staging_responses": [("batch_no",)],
    "staging_geography": [("country_name",), ("country_code_iso2",)],
    "staging_economics": [("year",)],
    "transformed_artworks": [("artwork_id",)],
    "transformed_artists": [("artist_id",)],
    "bridge_artwork_artist": [("artwork_id", "artist_id")],
    "transformed_geography": [("nationality",)],
    "transformed_date_economics": [("date_key",), ("year",)],
    "dim_date": [("date_key",), ("full_date",)],
    "dim_geography": [("nationality",)],
    "dim_artist": [("artist_id",)],
    "dim_artwork": [("artwork_id",)],
    "fact_artwork_acquisitions": [("acquisition_key",)],
    "fact_artist_summary": [("artist_summary_key",), ("artist_id", "snapshot_date")],
}

REQUIRED_COLUMNS = {
    "staging_artworks": ["object_id"],
    "staging_artists": ["constituent_id"],
    "staging_requests": ["wikidata_id"],
    "staging_enrichment": ["wikidata_id"],
    "staging_responses": ["batch_no"],
    "staging_geography": ["country_name", "country_code_iso2"],
    "staging_economics": ["year"],
    "transformed_artworks": ["artwork_id"],
    "transformed_artists": ["artist_id", "display_name"],
    "bridge_artwork_artist": ["artwork_id", "artist_id"],
    "transformed_geography": ["nationality", "country_name"],
    "transformed_date_economics": ["date_key", "full_date", "year"],
    "dim_date": ["date_key", "full_date", "year", "decade", "century"],
    "dim_geography": ["nationality", "country_name"],
    "dim_artist": ["artist_id", "display_name"],
    "dim_artwork": ["artwork_id"],
    "fact_artwork_acquisitions": ["acquisition_key", "artwork_id", "artist_id"],
    "fact_artist_summary": ["artist_summary_key", "artist_id", "snapshot_date"],
}

# child table -> (child column, parent table, parent column)
REFERENCES = {
    "bridge_artwork_artist": [
        ("artwork_id", "transformed_artworks", "artwork_id"),
        ("artist_id", "transformed_artists", "artist_id"),
    ],
    "fact_artwork_acquisitions": [
        ("artwork_id", "dim_artwork", "artwork_id"),
        ("artist_id", "dim_artist", "artist_id"),
        ("acquisition_date_key", "dim_date", "date_key"),
        ("creation_date_key", "dim_date", "date_key"),
    ],
    "fact_artist_summary": [("artist_id", "dim_artist", "artist_id")],
}
