"""Landed JSON responses: whole documents as text, and the country list as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse import rules
from starhouse.functions.classify import nationality
from starhouse.functions.text import strip
from starhouse.operators.dedup import keep_first

_COUNTRIES_SCHEMA = (
    "array<struct<name: struct<common: string>, cca2: string, cca3: string, region: string, "
    "subregion: string, continents: array<string>, latlng: array<double>>>"
)


LISTED = "_listed"


def read_documents(spark: SparkSession, path: str, key: str) -> DataFrame:
    """One row per file: its name under ``key``, its text as ``payload``.

    The name is that of the folder part ``key=name`` if files lie in such folders, else the file's
    base name without extension.
    """
    files = spark.read.text(path, wholetext=True)
    base_name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
    name = F.col(key).cast("string") if key in files.columns else base_name
    return files.select(name.alias(key), F.col("value").alias("payload"))


def flatten_countries(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """Country objects to flat rows; missing texts are empty, missing coordinates NULL.

    Countries without a name are dropped.  The column ``LISTED`` has where a country stands: document, position in it.
    """
    document = F.col("name").cast("string") if "name" in documents.columns else F.md5(payload)
    parsed = documents.select(
        document.alias("document"), F.posexplode(F.from_json(F.col(payload), _COUNTRIES_SCHEMA)).alias("position", "c")
    )

    def text(path: str):
        return F.coalesce(F.col(path), F.lit(""))

    return parsed.where(text("c.name.common") != "").select(
        strip(F.col("c.name.common")).alias("country_name"),
        text("c.cca2").alias("country_code_iso2"),
        text("c.cca3").alias("country_code_iso3"),
        F.coalesce(F.get("c.continents", F.lit(0)), F.lit("")).alias("continent"),
        text("c.region").alias("region"),
        text("c.subregion").alias("subregion"),
        F.get("c.latlng", F.lit(0)).alias("latitude"),
        F.get("c.latlng", F.lit(1)).alias("longitude"),
        F.lit(rules.COUNTRY_SOURCE).alias("source"),
        F.struct("document", "position").alias(LISTED),
    )


def with_unknown_country(countries: DataFrame) -> DataFrame:
    """The countries and, after them, the stand-in row for an unknown nationality."""
    blank = countries.sparkSession.range(1).select(
        *[F.lit(rules.UNKNOWN_COUNTRY.get(field.name)).cast(field.dataType).alias(field.name) for field in countries.schema]
    )
    ordered = countries.withColumn("_custom", F.lit(False))
    return ordered.unionByName(blank.withColumn("_custom", F.lit(True)))


def geography_reference(countries: DataFrame) -> DataFrame:
    """Geography staging table: stand-in row added, nationalities derived, the first listed row of each ISO-2 code."""
    named = with_unknown_country(countries).withColumn("nationality", nationality(F.col("country_name")))
    return (
        keep_first(named, ["country_code_iso2"], ["_custom", LISTED])
        .drop("_custom", LISTED)
        .withColumn("loaded_at", F.current_timestamp())
    )
