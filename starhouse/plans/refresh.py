"""The full refresh: staging, transformed and dimensional layer, each table written once."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date, datetime, timezone
from types import MappingProxyType

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starhouse import rules
from starhouse.operators import economics, enrichment, linking, numbering, quality, rejects
from starhouse.operators.dedup import drop_repeated
from starhouse.plans import artists, artworks, calendar, geography, star
from starhouse.sources import csv, json, versions
from starhouse.sources.tables import Written, read_rejected, read_table, write_table

#: Rows left out, and values that do not fit, that stop a refresh unless it allows more. What repeats a key is only reported.
STRICT = {rejects.NO_KEY: 0, rejects.BAD_KEY: 0, rejects.BAD_LIST_ID: 0, "rejected value": 0, "bindings nobody asked for": 0}


@dataclass(frozen=True)
class Sources:
    """Paths of the landed inputs.

    ``responses`` holds one JSON file per enrichment request, named by its batch number.  Artists are found in
    whatever batch has them, but only those of the same export are all asked for (see :func:`enrichment_requests`).
    ``artwork_columns`` and ``artist_columns`` name the header of one big file of that kind, which is then read by many
    tasks; without it, a file is one task.
    ``series`` holds one file per economic series, named as in :data:`starhouse.rules.SERIES_COLUMNS`.
    """

    artworks: str
    artists: str
    countries: str
    series: str
    responses: str
    artwork_columns: tuple[str, ...] | None = None
    artist_columns: tuple[str, ...] | None = None


class _Refresh:
    """Tables are written to a set of their own, which one switch makes the current one once every gate has passed.

    All load stamps have the time at which the refresh began.
    """

    def __init__(self, spark: SparkSession, root: str, allowed: Mapping[str, int]) -> None:
        self.spark, self.root, self.staged = spark, root, versions.new_set(root)
        self.at = datetime.now(timezone.utc)
        self.allowed = STRICT | dict(allowed)
        self.written: dict[str, Written] = {}

    def write(self, builds: Mapping[str, Callable[[], DataFrame]]) -> None:
        """Write tables that do not depend on each other at the same time."""
        with ThreadPoolExecutor(max_workers=len(builds)) as pool:
            jobs = {table: pool.submit(write_table, build(), self.staged, table, self.at) for table, build in builds.items()}
            for table, job in jobs.items():
                self.written[table] = job.result()
                for column, n in self.written[table].rejected.items():
                    self._limit(table, f"rejected value, {column}", n, "rejected value")

    def _limit(self, table: str, what: str, n: int, reason: str) -> None:
        if n > self.allowed.get(reason, n):
            raise quality.QualityError(f"{table}: {what}: {n}")

    def dropped(self, table: str, counts: Mapping[str, int]) -> None:
        """Note rows that the table leaves out, and stop if they are more than allowed."""
        found = {reason: n for reason, n in counts.items() if n}
        self.written[table] = replace(self.written[table], dropped=self.written[table].dropped | found)
        for reason, n in found.items():
            self._limit(table, reason, n, reason)

    def landed(self, table: str, seen: Observation) -> None:
        raw, no_key = seen.get["raw"], seen.get["no_key"]
        self.dropped(table, {rejects.NO_KEY: no_key, rejects.REPEATED_KEY: raw - no_key - self.written[table].rows})

    def quarantined(self, *tables: str) -> None:
        """Note the rows that writes of tables left out. The rejected values are read, not the table's source once more."""
        for table in tables:
            whole_rows = F.col("reason").isin(rejects.BAD_KEY, rejects.BAD_LIST_ID, rejects.UNKNOWN_ARTIST)
            counts = read_rejected(self.spark, self.staged, table).where(whole_rows).groupBy("reason").count()
            self.dropped(table, {row["reason"]: row["count"] for row in counts.collect()})

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, self.staged, table)

    def publish(self) -> None:
        versions.publish(self.spark, self.staged)
        versions.clean(self.spark, self.root)

    def check(self, *tables: str) -> None:
        quality.enforce(quality.declared_gates({table: self.read(table) for table in tables}))

    def require_rows(self, minimums: Mapping[str, int]) -> None:
        short = [table for table, least in minimums.items() if self.written[table].rows < least]
        if short:
            raise quality.QualityError("fewer rows than expected: " + ", ".join(f"{t} {self.written[t].rows}" for t in short))


def enrichment_requests(staging_artists: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """``artist_name, wikidata_id, batch_no`` of every artist with an external id of its own.

    With the requests ``before``, whoever was asked for under a number keeps it, and only others are dealt out.
    """
    found = drop_repeated(enrichment.artists_with_external_id(staging_artists), "wiki_qid")
    asked = found.select(F.col("display_name").alias("artist_name"), F.col("wiki_qid").alias("wikidata_id"))
    if before is None:
        return numbering.with_request_batch(asked, "wikidata_id")
    return numbering.sticky_batches(asked, "wikidata_id", before)


def run_refresh(
    spark: SparkSession, sources: Sources, root: str, snapshot_date: date | None = None,
    minimum_rows: Mapping[str, int] = rules.MINIMUM_ROWS, years: tuple[int, int] = rules.YEAR_SPINE,
    allowed: Mapping[str, int] = MappingProxyType({}),
) -> dict[str, Written]:
    """Rebuild every table under ``root`` from the landed inputs; returns what was written and left out.

    Layers follow each other and read the tables just written, so a lost executor costs the stage
    it was running.  Failed gates raise and leave all tables as they were; a refresh that stops anywhere before its last
    step leaves the set before it as the current one, and rejected values stay beside the tables (``read_rejected``).  ``allowed`` gives other limits
    than :data:`STRICT` for what a load may leave out, by reason.
    """
    run = _Refresh(spark, root, allowed)
    seen_artworks, seen_artists = Observation(), Observation()

    def landed(path: str, columns: tuple[str, ...] | None, headers: Mapping[str, str], key: str, seen: Observation) -> DataFrame:
        raw = csv.read_csv_text(spark, path) if columns is None else csv.read_big_csv_text(spark, path, columns)
        return csv.land(raw, headers, key, observation=seen)

    run.write({
        "staging_artworks": lambda: landed(sources.artworks, sources.artwork_columns, rules.ARTWORK_HEADERS, "object_id", seen_artworks),
        "staging_artists": lambda: landed(sources.artists, sources.artist_columns, rules.ARTIST_HEADERS, "constituent_id", seen_artists),
        "staging_geography": lambda: json.geography_reference(
            json.flatten_countries(json.read_documents(spark, sources.countries, "name"))
        ),
        "staging_economics": lambda: economics.economics_table(
            spark,
            economics.annual_average(economics.parse_observations(json.read_documents(spark, sources.series, "series"))),
            *years,
        ),
    })
    run.landed("staging_artworks", seen_artworks)
    run.landed("staging_artists", seen_artists)
    # The stand-in country is always there: without another the country list was empty or unreadable.
    run.require_rows({"staging_artworks": 1, "staging_artists": 1, "staging_geography": 2})
    run.check("staging_artworks", "staging_artists", "staging_geography", "staging_economics")

    responses = json.read_documents(spark, sources.responses, "batch_no").withColumn(
        "batch_no", F.col("batch_no").try_cast("bigint")
    )
    earlier = versions.current(spark, root)
    # Responses landed for the last set's requests, whose numbers stay as they were.
    before = None if earlier == root.rstrip("/") else read_table(spark, earlier, "staging_requests")
    run.write({
        "staging_requests": lambda: enrichment_requests(run.read("staging_artists"), before),
        "transformed_artworks": lambda: artworks.tagged_artworks(run.read("staging_artworks")),
        "bridge_artwork_artist": lambda: linking.tagged_bridge(
            run.read("staging_artworks"), artists.clean_artists(run.read("staging_artists"))
        ),
        "transformed_date_economics": lambda: calendar.transform_date_economics(run.read("staging_economics")),
    })
    run.quarantined("transformed_artworks", "bridge_artwork_artist")
    run.write({
        "staging_enrichment": lambda: enrichment.enrich_artists(run.read("staging_requests"), responses),
        "staging_responses": lambda: enrichment.raw_responses(responses),
    })
    foreign = enrichment.unrequested_bindings(run.read("staging_requests"), responses).first()
    run.dropped("staging_enrichment", {foreign["check"]: foreign["failures"]})
    run.write({
        "transformed_artists": lambda: linking.with_artist_stats(
            artists.transform_artists(run.read("staging_artists"), run.read("staging_enrichment"), quarantine=True),
            run.read("bridge_artwork_artist"), run.read("transformed_artworks"),
        ),
    })
    run.quarantined("transformed_artists")
    run.write({
        "transformed_geography": lambda: geography.transform_geography(
            run.read("staging_geography"), run.read("transformed_artists"), run.read("bridge_artwork_artist")
        ),
    })
    run.require_rows(minimum_rows)
    run.check(
        "transformed_artworks", "transformed_artists", "bridge_artwork_artist", "transformed_geography",
        "transformed_date_economics",
    )

    run.write({
        "dim_date": lambda: star.dim_date(run.read("transformed_date_economics")),
        "dim_geography": lambda: star.dim_geography(run.read("transformed_geography")),
        "dim_artist": lambda: star.dim_artist(run.read("transformed_artists")),
        "dim_artwork": lambda: star.dim_artwork(run.read("transformed_artworks")),
    })
    run.write({
        "fact_artwork_acquisitions": lambda: star.fact_artwork_acquisitions(
            run.read("transformed_artworks"), run.read("bridge_artwork_artist"), run.read("transformed_artists"),
            run.read("dim_date"),
        ),
    })
    run.write({
        "fact_artist_summary": lambda: star.fact_artist_summary(
            run.read("dim_artist"), run.read("fact_artwork_acquisitions"), run.read("dim_artwork"), run.read("dim_date"),
            snapshot_date,
        ),
    })
    run.check(
        "dim_date", "dim_geography", "dim_artist", "dim_artwork", "fact_artwork_acquisitions", "fact_artist_summary"
    )
    run.publish()
    return run.written
