"""The registered queries: every operator and table of the warehouse over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse import rules, schemas
from starhouse.functions import classify, dates
from starhouse.functions.text import blank_tokens
from starhouse.operators import dedup, economics, enrichment, intervals, linking, numbering, quality, rejects
from starhouse.plans import artists, artworks, reports, star
from starhouse.session import scratch_path
from starhouse.sources import csv as csv_source
from starhouse.sources import json as json_source
from starhouse.sources import partitions, tables
from verification import shapes
from verification.warehouse import SNAPSHOT, Warehouse, bindings_payload, presentable

Build = Callable[[Warehouse], DataFrame]


# --- Sources ---------------------------------------------------------------------------------


def _written_csv(w: Warehouse, df: DataFrame, headers: dict[str, str], label: str) -> str:
    path = scratch_path(w.spark, label)
    names = {column: header for header, column in headers.items()}
    df.withColumnsRenamed({name: names[name] for name in df.columns}).write.options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


def _landed(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns, F.col("source_file").endswith(".csv").alias("from_csv_file"))


def stage_artworks(w: Warehouse) -> DataFrame:
    source = w.shape("artworks")
    path = _written_csv(w, source, rules.ARTWORK_HEADERS, "artworks")
    return _landed(csv_source.land_artworks(w.spark, path), [*source.columns, "on_view"])


def stage_artists(w: Warehouse) -> DataFrame:
    source = w.shape("artists")
    path = _written_csv(w, source, rules.ARTIST_HEADERS, "artists")
    return _landed(csv_source.land_artists(w.spark, path), [*source.columns, "ulan"])


def stage_big_csv(w: Warehouse) -> DataFrame:
    """Titles with quoted line breaks and quotes, read back by the splitting reader."""
    source = w.shape("artworks").withColumn("title", F.concat(F.lit('say "hi"\n, line '), F.col("title")))
    path = _written_csv(w, source, rules.ARTWORK_HEADERS, "big")
    names = {column: header for header, column in rules.ARTWORK_HEADERS.items()}
    raw = csv_source.read_big_csv_text(w.spark, path, [names[name] for name in source.columns])
    return _landed(csv_source.land(raw, rules.ARTWORK_HEADERS, "object_id"), source.columns)


def stage_null_tokens(w: Warehouse) -> DataFrame:
    tokens = F.array(*[F.lit(token) for token in rules.NULL_TOKENS])
    size = len(rules.NULL_TOKENS)
    mixed = F.coalesce(F.get(tokens, (F.col("p_partkey") % (2 * size)).cast("int")), F.col("p_name"))
    return w.table("part").select("p_partkey", blank_tokens(mixed).alias("text"))


def scan_project_filter(w: Warehouse) -> DataFrame:
    return tables.project_filter(w.shape("artworks"), ["object_id", "title", "credit_line", "date_acquired"], "title")


def filter_external_ids(w: Warehouse) -> DataFrame:
    return enrichment.artists_with_external_id(w.shape("artists"))


def _untyped(w: Warehouse) -> DataFrame:
    return w.shape("artworks").select(
        F.col("object_id").alias("artwork_id"), "title", "height_cm", "width_cm", "date_acquired",
        F.substring("accession_number", 1, 3).alias("creation_year"),
    )


def conform_schema(w: Warehouse) -> DataFrame:
    return presentable(tables.conform(_untyped(w), "transformed_artworks").select(
        "artwork_id", "title", "height_cm", "width_cm", "depth_cm", "date_acquired", "creation_year"
    ))


def conform_rejects(w: Warehouse) -> DataFrame:
    return tables.rejected_values(_untyped(w), "transformed_artworks")


def sink_roundtrip(w: Warehouse) -> DataFrame:
    root = scratch_path(w.spark, "tables")
    tables.write_table(w.transformed_artworks, root, "transformed_artworks")
    return presentable(tables.read_table(w.spark, root, "transformed_artworks"))


def json_country_flatten(w: Warehouse) -> DataFrame:
    return json_source.flatten_countries(w.country_documents).drop(json_source.LISTED)


def json_observations(w: Warehouse) -> DataFrame:
    return economics.parse_observations(w.monthly_documents)


def json_bindings_flatten(w: Warehouse) -> DataFrame:
    bindings = w.shape("bindings")
    asked = numbering.with_request_batch(bindings.select("qid").distinct(), "qid")
    responses = bindings_payload(bindings.join(asked, "qid"), "batch_no")
    flat = enrichment.binding_rows(responses, "batch_no")
    return enrichment.only_requested(flat, asked).drop("batch_no", "pos").distinct()


# --- Parsers ---------------------------------------------------------------------------------


def parse_creation_date(w: Warehouse) -> DataFrame:
    return artworks.with_creation_date(w.shape("artworks")).select("object_id", "date", "creation_year", "date_certainty")


def parse_dimensions(w: Warehouse) -> DataFrame:
    return artworks.with_dimensions(w.shape("artworks")).select("object_id", "dimensions", "height_cm", "width_cm")


def parse_acquisition_date(w: Warehouse) -> DataFrame:
    return artworks.with_acquisition_date(w.shape("artworks")).select("object_id", "date_acquired", "acquisition_year")


def classify_acquisition_method(w: Warehouse) -> DataFrame:
    return w.shape("artworks").select("object_id", classify.acquisition_method(F.col("credit_line")).alias("acquisition_method"))


def clean_year(w: Warehouse) -> DataFrame:
    return w.people.select("constituent_id", "birth_year", "death_year", "is_living", "lifespan_years")


def standardize_gender(w: Warehouse) -> DataFrame:
    return w.shape("artists").select("constituent_id", classify.gender(F.col("gender")).alias("gender_clean"))


def assign_era(w: Warehouse) -> DataFrame:
    year = F.col("creation_year")
    return w.transformed_artworks.select("artwork_id", dates.era(year).alias("era"))


def date_parts(w: Warehouse) -> DataFrame:
    year = F.col("creation_year")
    return w.transformed_artworks.select(
        "artwork_id", dates.decade(year).alias("decade"), dates.century(year).alias("century"),
        dates.date_key(year).alias("date_key"), dates.first_of_january(year).alias("full_date"),
    )


def year_classify(w: Warehouse) -> DataFrame:
    year = F.col("creation_year")
    return w.transformed_artworks.select(
        "artwork_id", "creation_year", dates.economic_period(year).alias("economic_period"),
        dates.major_event(year).alias("major_events"),
    )


def fetch_status(w: Warehouse) -> DataFrame:
    return w.partly_failed_enrichment.select(
        "artist_name", "wikidata_id", "fetch_status", (F.col("fetch_status") != "failed").alias("has_response")
    )


def fetch_status_single(w: Warehouse) -> DataFrame:
    """One response per entity; some failed and some are empty, by the number in the id."""
    requests = w.requested
    number = F.substring("qid", 2, 20).cast("int")
    bindings = w.shape("bindings").join(requests.select(F.col("wikidata_id").alias("qid")), "qid")
    arrived = (
        F.when(number % 4 == 3, None).when(number % 5 == 0, '{"results": {"bindings": []}}')
        .when(number % 7 == 1, "<html>502</html>").when(number % 7 == 2, F.expr("substring(payload, 1, length(payload) - 3)"))
        .when(number % 7 == 3, "{}").otherwise(F.col("payload"))
    )
    responses = bindings_payload(bindings, "qid").withColumn("payload", arrived)
    # Some landed twice, once with white space around the text, and some first broken and then whole.
    again = responses.where(number % 3 == 0).withColumn("payload", F.concat("payload", F.lit(" ")))
    responses = responses.unionByName(again).unionByName(responses.where(number % 3 == 1).withColumn("payload", F.lit("<html>504</html>")))
    return presentable(enrichment.enrich_artists_singly(requests, responses).drop("api_response_json"))


def request_batches(w: Warehouse) -> DataFrame:
    return numbering.request_batches(w.requested, "wikidata_id", 5)


def sticky_batches(w: Warehouse) -> DataFrame:
    """Requests after an export that lost some artists and gained others: whoever stays keeps the batch."""
    number = F.substring("wikidata_id", 2, 20).cast("int")
    before = numbering.with_request_batch(w.requested.where(number % 7 != 3).select("wikidata_id"), "wikidata_id", 5)
    return numbering.sticky_batches(w.requested.where(number % 11 != 4).select("wikidata_id"), "wikidata_id", before, 5)


# --- Enrichment ------------------------------------------------------------------------------


def enrich_left_join(w: Warehouse) -> DataFrame:
    joined = artists.with_enrichment(w.shape("artists"), w.staging_enrichment)
    return presentable(joined.select("constituent_id", "wikidata_id", "has_wikidata_enrichment", "art_movements", "education"))


def _split_responses(w: Warehouse) -> DataFrame:
    """Bindings of every entity in two responses: those at even places in an earlier one, the others in a later one."""
    number = F.substring("qid", 2, 20).cast("int")
    return bindings_payload(w.shape("bindings").withColumn("batch_no", F.pmod(number, F.lit(7)) + 100 * (F.col("pos") % 2)), "batch_no")


def bindings_collect(w: Warehouse) -> DataFrame:
    return presentable(enrichment.merged_details(enrichment.response_details(_split_responses(w), "batch_no")))


def raw_responses(w: Warehouse) -> DataFrame:
    """The kept texts of answered batches, some of which came twice and some not at all, by their digest."""
    number = F.col("batch_no")
    texts = w.shape("bindings").groupBy((F.substring("qid", 2, 20).cast("int") % 11).alias("batch_no")).agg(
        F.concat(F.lit('{"n": '), F.count("*").cast("string"), F.lit("}")).alias("payload"))
    broken = F.when(number % 4 == 1, F.concat(F.col("payload"), F.lit("}"))).when(number % 4 == 2, F.lit(" {} ")).otherwise(F.col("payload"))
    landed = texts.withColumn("payload", broken)
    kept = enrichment.raw_responses(landed.unionByName(landed.where(number % 3 == 0).withColumn("payload", F.concat(F.lit(" "), "payload"))))
    return kept.select("batch_no", "api_response_json", F.md5("api_response_json").alias("digest"))


def enrichment_table(w: Warehouse) -> DataFrame:
    return presentable(w.staging_enrichment.drop("batch_no"))


def year_spine_join(w: Warehouse) -> DataFrame:
    return economics.on_spine(economics.year_spine(w.spark, *shapes.SPINE), w.annual_series)


def annual_resample(w: Warehouse) -> DataFrame:
    yearly = economics.annual_average(economics.parse_observations(w.monthly_documents))
    return yearly.select("series", "year", F.round("value", 2).alias("value"))


def _series_by_nation(w: Warehouse) -> DataFrame:
    """Yearly order totals of every nation, some years missing."""
    orders = w.table("orders").join(w.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    year = F.year("o_orderdate")
    sums = orders.groupBy(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("series"), year.alias("year")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value"))
    return sums.where((F.col("year") + F.substring("series", 2, 5).cast("int")) % 5 != 0)


def series_change(w: Warehouse) -> DataFrame:
    return economics.series_change(_series_by_nation(w)).withColumn("change_percent", F.round("change_percent", 4))


def year_ranges(w: Warehouse) -> DataFrame:
    """Whether the creation year of a work lies in one of many overlapping ranges of its department."""
    start = 1900 + F.col("s_suppkey") * 37 % 100
    ranges = w.table("supplier").select(
        F.element_at(F.array(*map(F.lit, ("Drawings", "Prints", "Film"))), (F.col("s_suppkey") % 3 + 1).cast("int")).alias("department"),
        start.alias("first"), (start + F.col("s_nationkey") % 4 - 1).alias("last"))
    works = w.transformed_artworks.select("artwork_id", "department", "creation_year")
    return intervals.with_range_flag(works, "creation_year", ranges, "in_range", 8, ["department"])


def stats_partitions(w: Warehouse) -> DataFrame:
    """Statistics written without a part of the works, then brought up to date part by part."""
    root = scratch_path(w.spark, "statistics")
    bridge = w.dated_bridge
    partitions.write_parts(linking.artist_stats(bridge.where("artwork_id % 50 != 0")), f"{root}/t", "artist_id", 16)
    now = linking.artist_stats(bridge)
    partitions.update_parts(now, f"{root}/t", "artist_id", 16, f"{root}/new")
    return partitions.read_parts(w.spark, f"{root}/t", now)


def pct_change(w: Warehouse) -> DataFrame:
    return w.staging_economics.select("year", F.round("inflation_rate_percent", 4).alias("inflation_rate_percent"))


def drop_all_duplicates(w: Warehouse) -> DataFrame:
    return dedup.drop_repeated(enrichment.artists_with_external_id(w.shape("artists")), "wiki_qid")


def keep_first_duplicate(w: Warehouse) -> DataFrame:
    """First line of every order by ship date: a key with several rows each."""
    lines = w.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return dedup.keep_first(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]).select(
        "l_orderkey", "l_partkey", "l_suppkey"
    )


def duplicate_profile(w: Warehouse) -> DataFrame:
    return dedup.duplicate_profile(w.table("lineitem"), "l_orderkey")


def duplicate_examples(w: Warehouse) -> DataFrame:
    return dedup.most_repeated(w.table("lineitem"), "l_orderkey")


# --- Tables ----------------------------------------------------------------------------------


def artwork_quality_score(w: Warehouse) -> DataFrame:
    return presentable(w.transformed_artworks.select("artwork_id", "data_quality_score"))


def artist_quality_score(w: Warehouse) -> DataFrame:
    return presentable(w.cleaned_artists.select("artist_id", "data_quality_score"))


def bridge_explode(w: Warehouse) -> DataFrame:
    listed = linking.listed_artists(w.shape("artwork_ids"))
    return listed.select("artwork_id", F.btrim("listed_id").try_cast("int").alias("artist_id"))


def bridge_rejects(w: Warehouse) -> DataFrame:
    """Listed ids that are no number, after some have been spoilt."""
    spoilt = w.shape("artwork_ids").withColumn("constituent_id", F.replace("constituent_id", F.lit("999999"), F.lit("n.n.")))
    return linking.bad_artist_ids(spoilt)


def nationality_map(w: Warehouse) -> DataFrame:
    return w.staging_geography.drop("loaded_at")


def customer_nationality(w: Warehouse) -> DataFrame:
    """Nationality of every customer's country, with real country names standing in for a part."""
    names = F.array(*[F.lit(name) for name in ("France", "Austria", "Yemen", "Nationality unknown", "Niger")])
    country = F.coalesce(F.get(names, (F.col("c_custkey") % 10).cast("int")), F.concat(F.lit("Land "), F.col("c_mktsegment")))
    return w.table("customer").select("c_custkey", classify.nationality(country).alias("nationality"))


def surrogate_key(w: Warehouse) -> DataFrame:
    return w.acquisitions.select("acquisition_key", "artwork_id", "artist_id")


# --- Gates -----------------------------------------------------------------------------------


def gate_row_counts(w: Warehouse) -> DataFrame:
    named = {
        "transformed_artworks": w.transformed_artworks, "transformed_artists": w.people,
        "bridge_artwork_artist": w.bridge,
    }
    return quality.minimum_rows(named, rules.MINIMUM_ROWS)


def gate_unique(w: Warehouse) -> DataFrame:
    return (
        quality.unique(w.bridge, ["artwork_id", "artist_id"], "bridge", w.link_tasks)
        .unionByName(quality.unique(w.acquisitions, ["acquisition_key"], "acquisitions", w.link_tasks))
        .unionByName(quality.unique(w.shape("artists"), ["wiki_qid"], "artists"))
    )


def gate_fk(w: Warehouse) -> DataFrame:
    listed = linking.listed_artists(w.shape("artwork_ids")).select(F.btrim("listed_id").try_cast("int").alias("artist_id"))
    return (
        quality.references(w.bridge, "artist_id", w.people, "artist_id", "bridge to artists")
        .unionByName(quality.references(w.bridge, "artwork_id", w.transformed_artworks, "artwork_id", "bridge to artworks"))
        .unionByName(quality.references(listed, "artist_id", w.people, "artist_id", "listed ids to artists"))
    )


def gate_declared(w: Warehouse) -> DataFrame:
    """All declared keys, required columns and references of the fact and its dimensions, once written.

    As in a refresh, what is made of written tables reads them: the summary those of the star, they one bridge.
    """
    root, w = scratch_path(w.spark, "gated"), w.on_written_bridge()

    def written(name: str, df: DataFrame) -> DataFrame:
        tables.write_table(df, root, name)
        return tables.read_table(w.spark, root, name)

    built = {name: written(name, df) for name, df in {
        "dim_date": w.dim_date, "dim_geography": w.dim_geography, "dim_artist": w.dim_artist, "dim_artwork": w.dim_artwork,
        "fact_artwork_acquisitions": w.acquisitions,
    }.items()}
    built["fact_artist_summary"] = written("fact_artist_summary", star.fact_artist_summary(
        built["dim_artist"], built["fact_artwork_acquisitions"], built["dim_artwork"], built["dim_date"], SNAPSHOT, w.link_tasks))
    return quality.declared_gates(built)


def gate_not_null(w: Warehouse) -> DataFrame:
    return quality.not_null(w.transformed_artworks, ["artwork_id", "title", "creation_year", "date_acquired"], "artworks")


# --- Reports ---------------------------------------------------------------------------------


def report_table_counts(w: Warehouse) -> DataFrame:
    return reports.star_counts({
        "date_records": w.dim_date, "geography_records": w.dim_geography,
        "artist_records": w.dim_artist, "artwork_records": w.dim_artwork, "acquisitions": w.acquisitions,
        "artist_summaries": w.artist_summary,
    })


def report_transformed_counts(w: Warehouse) -> DataFrame:
    return reports.star_counts({
        "artworks": w.transformed_artworks, "artists": w.cleaned_artists, "geography": w.transformed_geography,
        "date_economics": w.date_economics, "bridge": w.bridge,
    })


def load_rejects(w: Warehouse) -> DataFrame:
    """Rows a load leaves out, by reason, after keys and listed ids of the artworks have been spoilt in all four ways."""
    number = F.col("object_id").cast("bigint")
    spoilt = w.shape("artwork_ids").select(
        F.when(number % 11 == 0, None).when(number % 13 == 0, F.concat(F.lit("x"), "object_id"))
        .when(number % 17 == 0, F.lit("3000000000")).otherwise(F.col("object_id")).alias("object_id"),
        F.replace("constituent_id", F.lit("999999"), F.lit("n.n.")).alias("constituent_id"),
    )
    staging = dedup.keep_first(spoilt.where(F.col("object_id").isNotNull()), ["object_id"], ["constituent_id"])
    return (
        rejects.landing_rejects(spoilt, "object_id", "staging_artworks")
        .unionByName(rejects.bad_keys(staging, "object_id", "transformed_artworks"))
        .unionByName(rejects.bad_list_ids(linking.bad_artist_ids(
            w.shape("artwork_ids").withColumn("constituent_id", F.replace("constituent_id", F.lit("999999"), F.lit("n.n."))))))
    )


def rejected_rows(w: Warehouse) -> DataFrame:
    """Every value that the writes of three tables keep out, after some keys and listed ids have been spoilt."""
    root = scratch_path(w.spark, "quarantine")
    number = F.col("object_id").cast("bigint")
    works = w.shape("artworks").withColumn("object_id", F.when(number % 13 == 0, F.concat(F.lit("x"), "object_id")).otherwise(F.col("object_id")))
    listed = w.shape("artwork_ids").withColumn("constituent_id", F.when(
        number % 34 == 17, F.replace("constituent_id", F.lit("999999"), F.lit("n.n."))).otherwise(F.col("constituent_id")))
    tables.write_table(artworks.tagged_artworks(works), root, "transformed_artworks")
    tables.write_table(linking.tagged_bridge(listed, w.people), root, "bridge_artwork_artist")
    tables.write_table(artists.transform_artists(w.shape("artists"), w.staging_enrichment, quarantine=True), root, "transformed_artists")
    names = ("transformed_artworks", "bridge_artwork_artist", "transformed_artists")
    found = [tables.read_rejected(w.spark, root, name) for name in names]
    return found[0].unionByName(found[1]).unionByName(found[2])


def load_stamps(w: Warehouse) -> DataFrame:
    """Three tables written at one time: each stamp they have, how many rows, and how many different times."""
    root, at = scratch_path(w.spark, "stamped"), datetime(2005, 1, 1, tzinfo=timezone.utc)
    built = {"staging_economics": w.staging_economics, "transformed_artworks": w.transformed_artworks, "dim_artist": w.dim_artist}
    found = []
    for name, df in built.items():
        tables.write_table(df, root, name, at)
        for stamp in [x for x in schemas.LOAD_STAMPS if x in schemas.TABLES[name]]:
            found.append(tables.read_table(w.spark, root, name).agg(
                F.count("*").alias("n"), F.count_distinct(stamp).alias("times"), F.max(stamp).cast("string").alias("stamp")
            ).select(F.lit(name).alias("table_name"), F.lit(stamp).alias("column_name"), "*"))
    return found[0].unionByName(found[1]).unionByName(found[2])


def report_samples(w: Warehouse) -> DataFrame:
    return reports.sample(w.shape("artworks"), ["object_id", "title"], "title", [F.col("object_id").cast("bigint")])


def report_name_samples(w: Warehouse) -> DataFrame:
    return reports.sample(w.shape("artists"), ["display_name"], "display_name", ["display_name"])


def report_country_samples(w: Warehouse) -> DataFrame:
    columns = ["country_name", "country_code_iso2", "continent", "region", "nationality"]
    return reports.sample(w.staging_geography, columns, "country_name", ["country_name"], 10)


def report_influence_samples(w: Warehouse) -> DataFrame:
    return presentable(reports.sample(w.staging_enrichment, ["artist_name", "influenced_by"], "influenced_by", ["artist_name"], 10))


def report_staging_counts(w: Warehouse) -> DataFrame:
    return quality.row_counts({"staging_artworks": w.shape("artworks"), "staging_artists": w.shape("artists")})


def report_movement_samples(w: Warehouse) -> DataFrame:
    columns = ["artist_name", "movements", "birth_place", "birth_place_country"]
    return presentable(reports.sample(w.staging_enrichment, columns, "movements", ["artist_name"], 10))


def report_completeness(w: Warehouse) -> DataFrame:
    return reports.completeness(
        w.staging_enrichment, ["movements", "bio_text", "birth_place", "education", "influenced_by"],
        ["movements", "bio_text", "birth_place"],
    )


def report_economics_completeness(w: Warehouse) -> DataFrame:
    return reports.completeness(w.staging_economics, [
        "gdp_usd_billions", "inflation_rate_percent", "unemployment_rate_percent", "sp500_close",
    ])


def _share(column: str, table: str, digits: int = 1) -> Build:
    return lambda w: reports.percent_of_total(getattr(w, table), column, digits)


def _counts(column: str, table: str) -> Build:
    return lambda w: reports.category_counts(getattr(w, table), column)


QUERIES: dict[str, Build] = {
    "stage_artworks": stage_artworks,
    "stage_artists": stage_artists,
    "stage_big_csv": stage_big_csv,
    "stage_null_tokens": stage_null_tokens,
    "scan_project_filter": scan_project_filter,
    "filter_external_ids": filter_external_ids,
    "conform_schema": conform_schema,
    "conform_rejects": conform_rejects,
    "sink_roundtrip": sink_roundtrip,
    "json_country_flatten": json_country_flatten,
    "json_observations": json_observations,
    "json_bindings_flatten": json_bindings_flatten,
    "parse_creation_date": parse_creation_date,
    "parse_dimensions": parse_dimensions,
    "parse_acquisition_date": parse_acquisition_date,
    "classify_acquisition_method": classify_acquisition_method,
    "artwork_quality_score": artwork_quality_score,
    "clean_year": clean_year,
    "standardize_gender": standardize_gender,
    "artist_quality_score": artist_quality_score,
    "assign_era": assign_era,
    "date_parts": date_parts,
    "nationality_map": nationality_map,
    "customer_nationality": customer_nationality,
    "fetch_status": fetch_status,
    "fetch_status_single": fetch_status_single,
    "request_batches": request_batches,
    "sticky_batches": sticky_batches,
    "enrich_left_join": enrich_left_join,
    "bindings_collect": bindings_collect,
    "raw_responses": raw_responses,
    "enrichment_table": enrichment_table,
    "year_spine_join": year_spine_join,
    "annual_resample": annual_resample,
    "pct_change": pct_change,
    "series_change": series_change,
    "year_ranges": year_ranges,
    "stats_partitions": stats_partitions,
    "year_classify": year_classify,
    "drop_all_duplicates": drop_all_duplicates,
    "keep_first_duplicate": keep_first_duplicate,
    "duplicate_profile": duplicate_profile,
    "duplicate_examples": duplicate_examples,
    "artworks_transform": lambda w: presentable(w.transformed_artworks),
    "artists_transform": lambda w: presentable(w.cleaned_artists),
    "bridge_explode": bridge_explode,
    "bridge_rejects": bridge_rejects,
    "bridge_build": lambda w: w.bridge,
    "artist_stats_update": lambda w: presentable(w.transformed_artists.select(
        "artist_id", "display_name", "total_artworks_in_collection", "first_acquisition_year", "last_acquisition_year"
    )),
    "geography_transform": lambda w: presentable(w.transformed_geography),
    "economics_build": lambda w: presentable(
        w.staging_economics.withColumn("inflation_rate_percent", F.round("inflation_rate_percent", 4))
    ),
    "date_economics": lambda w: presentable(
        w.date_economics.withColumn("inflation_rate_percent", F.round("inflation_rate_percent", 4))
    ),
    "dim_date": lambda w: presentable(w.dim_date.withColumn("inflation_rate_percent", F.round("inflation_rate_percent", 4))),
    "dim_geography": lambda w: presentable(w.dim_geography),
    "dim_artist": lambda w: presentable(w.dim_artist),
    "dim_artwork": lambda w: presentable(w.dim_artwork),
    "fact_acquisitions": lambda w: presentable(w.acquisitions),
    "fact_artist_summary": lambda w: presentable(w.artist_summary),
    "surrogate_key": surrogate_key,
    "movement_explode": lambda w: star.movement_counts(w.dim_artist),
    "gate_row_counts": gate_row_counts,
    "gate_unique": gate_unique,
    "gate_fk": gate_fk,
    "gate_not_null": gate_not_null,
    "gate_declared": gate_declared,
    "report_table_counts": report_table_counts,
    "report_transformed_counts": report_transformed_counts,
    "load_rejects": load_rejects,
    "rejected_rows": rejected_rows,
    "load_stamps": load_stamps,
    "report_samples": report_samples,
    "report_movement_samples": report_movement_samples,
    "report_name_samples": report_name_samples,
    "report_country_samples": report_country_samples,
    "report_influence_samples": report_influence_samples,
    "report_staging_counts": report_staging_counts,
    "report_category_counts": _counts("continent", "staging_geography"),
    "report_date_certainty": _counts("date_certainty", "transformed_artworks"),
    "report_acquisition_methods": _counts("acquisition_method", "transformed_artworks"),
    "report_completeness": report_completeness,
    "report_economics_completeness": report_economics_completeness,
    "report_bridge_coverage": lambda w: reports.bridge_coverage(w.bridge),
    "report_by_continent": lambda w: reports.by_continent(w.transformed_geography),
    "report_top_geography": lambda w: reports.top_geography(w.transformed_geography),
    "report_quality_tiers": lambda w: presentable(reports.quality_tiers(w.cleaned_artists)),
    "report_artwork_tiers": lambda w: presentable(reports.quality_tiers(w.transformed_artworks)),
    "report_collaborations": lambda w: reports.collaborations(w.bridge),
    "report_prolific": lambda w: reports.prolific_artists(w.transformed_artists),
    "report_pct_of_total": lambda w: reports.top_shares(w.transformed_artworks, "classification"),
    "report_gender_shares": _share("gender_clean", "people"),
    "report_enrichment_shares": _share("has_wikidata_enrichment", "cleaned_artists"),
    "report_status_shares": _share("fetch_status", "partly_failed_enrichment", 2),
    "report_top_nationalities": lambda w: reports.top_nationalities(w.people),
    "report_era_distribution": lambda w: reports.era_distribution(w.date_economics),
    "report_calendar_summary": lambda w: reports.calendar_summary(w.date_economics),
    "report_war_or_recession": lambda w: reports.war_or_recession_years(w.date_economics),
    "report_recession_years": lambda w: reports.recession_years(w.staging_economics),
    "report_chosen_years": lambda w: reports.chosen_years(
        w.staging_economics.withColumn("inflation_rate_percent", F.round("inflation_rate_percent", 4)), (1994, 1996, 1998, 2000)
    ),
    "report_artist_movements": lambda w: presentable(
        reports.artist_movements(w.dim_artist, w.dim_geography, w.artist_summary)
    ),
    "analytics_top_artists": lambda w: reports.top_artists(w.acquisitions, w.dim_artist, w.dim_geography),
    "analytics_recession_acquisitions": lambda w: reports.recession_acquisitions(w.acquisitions, w.dim_date),
}


_warehouses: dict[tuple[SparkSession, str], Warehouse] = {}


def query(build: Build) -> Callable[[SparkSession, str], DataFrame]:
    """The query as a function of session and folder.

    The lazy table definitions of one session and folder are built once; no data is kept.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if (spark, sf_dir) not in _warehouses:
            _warehouses[spark, sf_dir] = Warehouse(spark, sf_dir)
        return build(_warehouses[spark, sf_dir])

    return run
