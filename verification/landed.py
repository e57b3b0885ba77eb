"""The input shapes written as the files that a full refresh reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse import rules
from starhouse.plans.refresh import Sources
from verification.warehouse import Warehouse, bindings_payload


def _csv(df: DataFrame, headers: dict[str, str], path: str) -> None:
    names = {column: header for header, column in headers.items()}
    df.withColumnsRenamed({name: names[name] for name in df.columns}).write.options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def _documents(df: DataFrame, key: str, path: str) -> None:
    """One file per document, in a folder named by its key."""
    df.select(key, "payload").repartition(8, key).write.partitionBy(key).text(path)


def land_inputs(spark: SparkSession, sf_dir: str, folder: str) -> Sources:
    w = Warehouse(spark, sf_dir)
    sources = Sources(*[f"{folder}/{name}" for name in ("artworks", "artists", "countries", "series", "responses")])
    artworks = w.shape("artworks").join(w.shape("artwork_ids"), "object_id", "left").repartition(8)
    _csv(artworks, rules.ARTWORK_HEADERS, sources.artworks)
    _csv(w.shape("artists"), rules.ARTIST_HEADERS, sources.artists)
    _documents(w.country_documents.withColumn("name", F.md5("payload")), "name", sources.countries)
    observed = F.struct(
        F.concat("year", F.lit("-01-01")).alias("date"), F.round("value", 2).cast("string").alias("value")
    )
    series = w.annual_series.groupBy("series").agg(F.collect_list(observed).alias("observations"))
    _documents(series.withColumn("payload", F.to_json(F.struct("observations"))), "series", sources.series)
    asked = w.requests().select(F.col("wikidata_id").alias("qid"), "batch_no")
    _documents(bindings_payload(w.shape("bindings").join(asked, "qid"), "batch_no"), "batch_no", sources.responses)
    return sources
