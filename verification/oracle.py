"""Comparison SQL for the registered queries.

Each statement is built from named common table expressions, written from the rules and not from
the Spark code: left joins, window counts and distinct counts as a relational database would run them.
"""

from __future__ import annotations

from starhouse import rules
from verification.shapes import SPINE, oracle_shape
from verification.warehouse import SMALL_BATCH, SNAPSHOT


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(value) for value in values)


def _starts(column: str, prefixes) -> str:
    return "(" + " OR ".join(f"starts_with({column}, {_text(prefix)})" for prefix in prefixes) + ")"


_SPACE = " || ".join(f"chr({ord(char)})" for char in rules.WHITESPACE)


def _strip(column: str) -> str:
    return f"trim({column}, {_SPACE})"


def _era(year: str) -> str:
    cases = " ".join(f"WHEN {year} <= {last} THEN {_text(name)}" for last, name in rules.ERAS)
    return f"CASE WHEN {year} IS NULL THEN NULL {cases} ELSE {_text(rules.LATEST_ERA)} END"


def _period(year: str) -> str:
    ranges = " OR ".join(f"{year} BETWEEN {start} AND {end}" for start, end in rules.RECESSIONS)
    return f"CASE WHEN {ranges} THEN 'Recession' ELSE 'Expansion' END"


def _event(year: str) -> str:
    cases = " ".join(f"WHEN {event_year} THEN {_text(event)}" for event_year, event in rules.MAJOR_EVENTS.items())
    return f"CASE {year} {cases} END"


def _nationality(country: str) -> str:
    cases = " ".join(f"WHEN {_text(name)} THEN {_text(adjective)}" for name, adjective in rules.NATIONALITIES.items())
    rule = (
        f"CASE WHEN {country} LIKE '%a' THEN lower({country}[:-2]) || 'an' ELSE lower({country}) || 'ian' END"
    )
    return f"CASE {country} {cases} ELSE {rule} END"


def _tier(score: str) -> str:
    cases = " ".join(f"WHEN round({score} * 100) >= {bound} THEN {_text(label)}" for bound, label in rules.QUALITY_TIERS)
    return f"CASE {cases} ELSE {_text(rules.LOWEST_TIER)} END"


_LIFE_YEAR = "CASE WHEN trunc(try_cast({0} AS double)) BETWEEN 1000 AND 2025 THEN CAST(trunc(try_cast({0} AS double)) AS int) END"
_NUMBERS = r"regexp_extract_all(regexp_extract(dimensions, '(?i)(.+?)\s*cm', 1), '([0-9]+\.?[0-9]*)', 1)"
_DETAILS = ("movements", "bio_text", "birth_place", "education", "influenced_by")
_HAS_DETAIL = " OR ".join(f"{name} IS NOT NULL" for name in _DETAILS)


def _collected(source: str) -> str:
    """Ordered distinct labels as joined text, first labels as scalars, per qid."""
    def listed(column: str, alias: str, separator: str) -> str:
        return (
            f"(SELECT string_agg(v, '{separator}' ORDER BY p) FROM (SELECT {column} AS v, min(pos) AS p FROM {source} x"
            f" WHERE x.qid = ids.qid AND {column} <> '' GROUP BY {column})) AS {alias}"
        )

    def first(column: str) -> str:
        return f"(SELECT arg_min({column}, pos) FROM {source} x WHERE x.qid = ids.qid AND {column} <> '') AS {column}"

    parts = [
        listed("movement", "movements", "|"), listed("education", "education", ", "),
        listed("influenced_by", "influenced_by", "|"),
        *[first(name) for name in ("birth_place", "birth_place_country", "death_place", "bio_text")],
    ]
    return f"SELECT qid, {', '.join(parts)} FROM (SELECT DISTINCT qid FROM {source}) ids"


# Name -> (names it reads, SQL).
_TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "s_artworks": ((), oracle_shape("artworks")),
    "s_artists": ((), oracle_shape("artists")),
    "s_ids": ((), oracle_shape("artwork_ids")),
    "s_bindings": ((), oracle_shape("bindings")),
    "s_countries": ((), oracle_shape("countries")),
    "s_series": ((), oracle_shape("series")),
    "s_monthly": ((), oracle_shape("monthly")),
    "dated": (("s_artworks",), f"""
        SELECT *, CASE WHEN circa OR dated THEN try_cast(runs[1] AS int)
            WHEN ranged THEN CAST(floor((CAST(runs[1] AS int) + CAST(runs[2] AS int)) / 2) AS int)
            WHEN try_cast(runs[1] AS int) BETWEEN 1000 AND 2024 THEN try_cast(runs[1] AS int) END AS creation_year,
          CASE WHEN circa THEN 'circa' WHEN dated THEN 'exact' WHEN ranged THEN 'range'
            WHEN try_cast(runs[1] AS int) BETWEEN 1000 AND 2024 THEN 'exact' ELSE 'unknown' END AS date_certainty
        FROM (SELECT *, {_starts('s', rules.CIRCA_PREFIXES)} AS circa, {_starts('s', rules.DATED_PREFIXES)} AS dated,
                contains(s, '-') AND length(s) <= 10 AND len(runs) = 2 AS ranged
              FROM (SELECT *, regexp_extract_all(s, '([0-9]{{4}})', 1) AS runs
                    FROM (SELECT *, {_strip("coalesce(date, '')")} AS s FROM s_artworks) a) b) c"""),
    "measured": (("s_artworks",), f"""
        SELECT object_id, dimensions,
          coalesce(try_cast(height_cm AS double), CASE WHEN len(n) >= 2 THEN CAST(n[-2] AS double) END) AS height_cm,
          coalesce(try_cast(width_cm AS double), CASE WHEN len(n) >= 2 THEN CAST(n[-1] AS double) END) AS width_cm
        FROM (SELECT *, {_NUMBERS} AS n FROM s_artworks) a"""),
    "t_artworks": (("dated", "measured"), """
        SELECT CAST(object_id AS int) AS artwork_id, title, creation_year, date AS creation_date_raw, date_certainty,
          medium, classification, department, height_cm, width_cm, CAST(NULL AS double) AS depth_cm,
          dimensions AS dimensions_text, acquired AS date_acquired, CAST(year(acquired) AS int) AS acquisition_year,
          credit_line, acquisition_method, accession_number, flag AS cataloged, url AS museum_url, image_url,
          round((CASE WHEN length(title) > 0 THEN 15 ELSE 0 END + CASE WHEN date <> '' THEN 25 ELSE 0 END
            + CASE WHEN acquired IS NOT NULL THEN 15 ELSE 0 END
            + CASE WHEN height_cm IS NOT NULL AND width_cm IS NOT NULL THEN 20 ELSE 0 END
            + CASE WHEN classification <> '(not assigned)' THEN 15 ELSE 0 END
            + CASE WHEN flag THEN 10 ELSE 0 END) / 100.0, 2) AS data_quality_score
        FROM (SELECT d.* EXCLUDE (height_cm, width_cm, dimensions), m.height_cm, m.width_cm, m.dimensions,
                CAST(try_strptime(d.date_acquired, '%Y-%m-%d') AS date) AS acquired,
                coalesce(upper(d.cataloged) IN ('Y', 'YES', 'TRUE', '1'), FALSE) AS flag,
                CASE WHEN lower(d.credit_line) LIKE '%exchange%' THEN 'Exchange'
                  WHEN lower(d.credit_line) LIKE '%bequest%' THEN 'Bequest'
                  WHEN lower(d.credit_line) LIKE '%purchase%' THEN 'Purchase'
                  WHEN regexp_matches(lower(d.credit_line), 'gift|louis e. stern|fund for the twenty-first century|given')
                    THEN 'Gift' ELSE 'Unknown' END AS acquisition_method
              FROM dated d JOIN measured m USING (object_id)) w"""),
    "with_id": (("s_artists",), """
        SELECT display_name, wiki_qid, nationality, begin_date, end_date FROM s_artists
        WHERE wiki_qid IS NOT NULL AND wiki_qid NOT IN ('', 'None')"""),
    "requested": (("with_id",), """
        SELECT *, row_number() OVER (ORDER BY md5(wiki_qid), wiki_qid) - 1 AS no
        FROM (SELECT *, count(*) OVER (PARTITION BY wiki_qid) AS copies FROM with_id) c WHERE copies = 1"""),
    "collected": (("s_bindings",), _collected("s_bindings")),
    "enriched": (("requested", "collected"), f"""
        SELECT r.display_name AS artist_name, r.wiki_qid AS wikidata_id, c.* EXCLUDE (qid),
          CASE WHEN {_HAS_DETAIL} THEN 'success' ELSE 'no_data' END AS fetch_status
        FROM requested r LEFT JOIN collected c ON r.wiki_qid = c.qid"""),
    "part_enriched": (("requested", "collected"), f"""
        SELECT r.display_name AS artist_name, r.wiki_qid AS wikidata_id, no // {SMALL_BATCH} % 7 NOT IN (1, 2, 3, 4) AS has_response,
          CASE WHEN no // {SMALL_BATCH} % 7 IN (1, 2, 3, 4) THEN 'failed' WHEN {_HAS_DETAIL} THEN 'success' ELSE 'no_data' END AS fetch_status
        FROM requested r LEFT JOIN collected c ON r.wiki_qid = c.qid"""),
    "t_artists": (("s_artists", "enriched"), f"""
        SELECT *, round((CASE WHEN birth_year IS NOT NULL THEN 20 ELSE 0 END
            + CASE WHEN nationality <> 'Unknown' THEN 20 ELSE 0 END + CASE WHEN gender_clean <> 'Unknown' THEN 15 ELSE 0 END
            + CASE WHEN length(display_name) > 0 THEN 15 ELSE 0 END
            + CASE WHEN death_year IS NOT NULL OR is_living THEN 10 ELSE 0 END
            + CASE WHEN has_wikidata_enrichment THEN 20 ELSE 0 END) / 100.0, 2) AS data_quality_score
        FROM (SELECT CAST(constituent_id AS int) AS artist_id, display_name, birth_year, death_year,
                death_year IS NULL AS is_living, death_year - birth_year AS lifespan_years, nationality,
                CASE WHEN g IN ('male', 'm', '(male)') THEN 'Male' WHEN g IN ('female', 'f', '(female)') THEN 'Female'
                  WHEN g IN ('non-binary', 'nonbinary', 'nb', 'gender non-conforming', 'transgender woman',
                    'female transwoman') THEN 'Non-binary' ELSE 'Unknown' END AS gender_clean,
                wikidata_id, wikidata_id IS NOT NULL AS has_wikidata_enrichment, movements AS art_movements,
                birth_place, birth_place_country, death_place, education, influenced_by
              FROM (SELECT *, {_LIFE_YEAR.format('begin_date')} AS birth_year, {_LIFE_YEAR.format('end_date')} AS death_year,
                      lower({_strip('gender')}) AS g FROM s_artists) a
              LEFT JOIN (SELECT * FROM enriched WHERE fetch_status = 'success') e ON a.wiki_qid = e.wikidata_id) b"""),
    "listed": (("s_ids",), """
        SELECT CAST(object_id AS int) AS artwork_id, CAST(trim(v) AS int) AS artist_id
        FROM (SELECT object_id, unnest(string_split(constituent_id, ',')) AS v FROM s_ids
              WHERE constituent_id IS NOT NULL AND constituent_id <> '') u"""),
    "bridge": (("listed", "t_artworks", "s_artists"), """
        SELECT DISTINCT artwork_id, artist_id, CAST(len(ids) AS int) AS artists_total
        FROM (SELECT artwork_id, ids, unnest(ids) AS artist_id
              FROM (SELECT artwork_id, list(artist_id) AS ids FROM listed GROUP BY artwork_id) per_work) pair
        WHERE artist_id IN (SELECT CAST(constituent_id AS int) FROM s_artists)
          AND artwork_id IN (SELECT artwork_id FROM t_artworks)"""),
    "a_stats": (("t_artists", "bridge", "t_artworks"), """
        SELECT p.*, CAST(coalesce(works, 0) AS int) AS total_artworks_in_collection, first_acquisition_year, last_acquisition_year
        FROM t_artists p
        LEFT JOIN (SELECT artist_id, count(*) AS works FROM bridge GROUP BY ALL) USING (artist_id)
        LEFT JOIN (SELECT artist_id, min(acquisition_year) AS first_acquisition_year
                   FROM bridge JOIN t_artworks USING (artwork_id) GROUP BY ALL) USING (artist_id)
        LEFT JOIN (SELECT artist_id, max(acquisition_year) AS last_acquisition_year
                   FROM bridge JOIN t_artworks USING (artwork_id) GROUP BY ALL) USING (artist_id)"""),
    "geo_reference": (("s_countries",), f"""
        SELECT * EXCLUDE (rn, custom, listed) FROM (
          SELECT *, {_nationality('country_name')} AS nationality,
            row_number() OVER (PARTITION BY country_code_iso2 ORDER BY custom, listed) AS rn
          FROM (SELECT {_strip('country_name')} AS country_name, country_code_iso2, country_code_iso3, continent, region,
                  subregion, latitude, longitude, {_text(rules.COUNTRY_SOURCE)} AS source, 0 AS custom, listed FROM s_countries
                UNION ALL SELECT 'Nationality unknown', 'XX', 'XXX', 'Unknown', 'Unknown', 'Unknown', NULL, NULL,
                  'Custom mapping', 1, 0) u) k WHERE rn = 1"""),
    "t_geography": (("geo_reference", "t_artists", "bridge"), """
        SELECT nationality, country_name, country_code_iso2, country_code_iso3, continent, region, subregion, latitude, longitude,
          CAST(coalesce(people[nationality], 0) AS int) AS total_artists, CAST(coalesce(works[nationality], 0) AS int) AS total_artworks
        FROM geo_reference,
          (SELECT histogram(home) AS people FROM (SELECT lower(trim(nationality)) AS home FROM t_artists)),
          (SELECT histogram(home) AS works FROM (
             SELECT DISTINCT artwork_id, (SELECT lower(trim(p.nationality)) FROM t_artists p WHERE p.artist_id = bridge.artist_id) AS home FROM bridge))"""),
    "spine": (("s_series",), f"""
        SELECT y.year, CAST(gdp AS double) AS gdp_usd_billions, cpi
        FROM (SELECT CAST(unnest(range({SPINE[0]}, {SPINE[1] + 1})) AS int) AS year) y LEFT JOIN s_series s ON y.year = s.year"""),
    "economics": (("spine",), f"""
        SELECT year, gdp_usd_billions, round((filled / lag(filled) OVER (ORDER BY year) - 1) * 100, 4) AS inflation_rate_percent,
          CAST(NULL AS double) AS unemployment_rate_percent, CAST(NULL AS double) AS sp500_close,
          {_event('year')} AS major_events, {_period('year')} AS economic_period
        FROM (SELECT *, last_value(cpi IGNORE NULLS) OVER (ORDER BY year ROWS UNBOUNDED PRECEDING) AS filled FROM spine) f"""),
    "calendar": (("economics",), f"""
        SELECT CAST(year * 10000 + 101 AS int) AS date_key, make_date(year, 1, 1) AS full_date, year,
          CAST(floor(year / 10) * 10 AS int) AS decade, CAST(floor(year / 100) AS int) AS century, {_era('year')} AS era,
          gdp_usd_billions, inflation_rate_percent, unemployment_rate_percent, sp500_close, economic_period, major_events
        FROM economics"""),
    "d_artist": (("a_stats",), """
        SELECT artist_id, display_name, birth_year, death_year, is_living, lifespan_years, lower(nationality) AS nationality,
          birth_place, death_place, gender_clean AS gender, wikidata_id, art_movements, education, influenced_by,
          total_artworks_in_collection AS total_artworks, first_acquisition_year, last_acquisition_year, data_quality_score,
          has_wikidata_enrichment FROM a_stats
        UNION ALL SELECT 0, 'Unknown Artist', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
          0, NULL, NULL, 0, FALSE"""),
    "d_artwork": (("t_artworks",), """
        SELECT * EXCLUDE (date_acquired, acquisition_year), CAST(floor(creation_year / 10) * 10 AS int) AS creation_decade,
          CAST(floor(creation_year / 100) AS int) AS creation_century FROM t_artworks"""),
    "fact": (("t_artworks", "bridge", "t_artists", "calendar"), """
        SELECT (CAST(artwork_id AS bigint) << 32) + artist_id AS acquisition_key, artwork_id, artist_id,
          (SELECT date_key FROM calendar WHERE year = bought) AS acquisition_date_key,
          (SELECT date_key FROM calendar WHERE year = made) AS creation_date_key,
          nationality, accession_number, if(bought < made, 0, bought - made) AS years_from_creation_to_acquisition,
          acquisition_method = 'Gift' AS is_gift, acquisition_method = 'Purchase' AS is_purchase,
          acquisition_method = 'Bequest' AS is_bequest, is_living AS is_living_artist_at_acquisition,
          coalesce(made >= bought - 20, FALSE) AS is_contemporary, cataloged AS is_cataloged,
          coalesce(gender_clean = 'Female', FALSE) AS is_female_artist
        FROM (SELECT artwork_id, artist_id, acquisition_year AS bought, creation_year AS made, accession_number, acquisition_method,
                cataloged, nationality, is_living, gender_clean
              FROM bridge JOIN t_artworks USING (artwork_id) JOIN t_artists USING (artist_id)
              UNION ALL
              SELECT artwork_id, 0, acquisition_year, creation_year, accession_number, acquisition_method, cataloged, NULL, NULL, NULL
              FROM t_artworks WHERE artwork_id NOT IN (SELECT artwork_id FROM bridge)) row_of"""),
    "summary": (("d_artist", "fact", "d_artwork", "calendar"), f"""
        SELECT (CAST(artist_id AS bigint) << 32) + {SNAPSHOT:%Y%m%d} AS artist_summary_key, artist_id, p.nationality,
          DATE '{SNAPSHOT}' AS snapshot_date, CAST(coalesce(works, 0) AS int) AS total_artworks,
          first_acquisition_year, last_acquisition_year, last_acquisition_year - first_acquisition_year AS span_of_acquisitions_years,
          earliest_artwork_year, latest_artwork_year, avg_years_to_acquisition,
          artist_id IN (SELECT f.artist_id FROM fact f JOIN d_artwork USING (artwork_id)
                        WHERE creation_year >= {SNAPSHOT.year - 20}) AS has_contemporary_works
        FROM (SELECT artist_id, nationality FROM d_artist) p
        LEFT JOIN (SELECT artist_id, count(*) AS works FROM fact GROUP BY ALL) USING (artist_id)
        LEFT JOIN (SELECT artist_id, min(year) AS first_acquisition_year, max(year) AS last_acquisition_year
                   FROM fact JOIN calendar ON date_key = acquisition_date_key GROUP BY ALL) b USING (artist_id)
        LEFT JOIN (SELECT artist_id, min(creation_year) AS earliest_artwork_year, max(creation_year) AS latest_artwork_year
                   FROM fact JOIN d_artwork USING (artwork_id) GROUP BY ALL) m USING (artist_id)
        LEFT JOIN (SELECT artist_id, round(avg(years_from_creation_to_acquisition), 0) AS avg_years_to_acquisition
                   FROM fact GROUP BY ALL) w USING (artist_id)"""),
}


def _needed(names: tuple[str, ...], found: dict[str, None]) -> dict[str, None]:
    for name in names:
        if name not in found:
            _needed(_TABLES[name][0], found)
            found[name] = None
    return found


def _sql(names: str, select: str) -> str:
    """``select`` with the tables it reads, and the ones those read, in front."""
    ctes = ",\n".join(f"{name} AS ({_TABLES[name][1]})" for name in _needed(tuple(names.split()), {}))
    if select.lstrip().startswith("WITH"):
        select = f"FROM ({select})"
    return f"WITH {ctes}\n{select}" if ctes else select


def _counts(table: str, column: str) -> str:
    return _sql(table, f"SELECT {column}, count(*) AS n FROM {table} GROUP BY 1")


def _shares(table: str, column: str, digits: int = 1, limit: str = "") -> str:
    return _sql(table, f"""SELECT {column}, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), {digits}) AS percentage
        FROM {table} GROUP BY 1 ORDER BY n DESC, {column} {limit}""")


def _tiers(table: str) -> str:
    return _sql(table, f"""SELECT {_tier('data_quality_score')} AS quality_tier, count(*) AS n,
        round(avg(data_quality_score), 2) AS avg_score FROM {table} GROUP BY 1""")


def _gate(check: str, failures: str) -> str:
    return f"SELECT {_text(check)} AS check, CAST(coalesce(({failures}), 0) AS bigint) AS failures"


def _repeated(table: str, keys: str) -> str:
    return f"SELECT count(*) FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1)"


def _null_token_columns(columns: str, tokens) -> str:
    return ", ".join(f"CASE WHEN {name} IN ({_list(tokens)}) THEN NULL ELSE {name} END AS {name}" for name in columns.split())


_ARTWORK_COLUMNS = (
    "object_id title date dimensions height_cm width_cm credit_line date_acquired cataloged classification medium"
    " department accession_number url image_url"
)
_ARTIST_COLUMNS = "constituent_id display_name nationality gender begin_date end_date wiki_qid"
_TOKENS = "[" + _list(rules.NULL_TOKENS) + "]"
_COUNTRY_NAMES = "['France', 'Austria', 'Yemen', 'Nationality unknown', 'Niger']"

ORACLE: dict[str, str] = {
    "stage_artworks": _sql("s_artworks", f"SELECT {_null_token_columns(_ARTWORK_COLUMNS, rules.NULL_TOKENS)}, CAST(NULL AS string) AS on_view, TRUE AS from_csv_file FROM s_artworks"),
    "stage_artists": _sql("s_artists", f"SELECT {_null_token_columns(_ARTIST_COLUMNS, rules.NULL_TOKENS)}, CAST(NULL AS string) AS ulan, TRUE AS from_csv_file FROM s_artists"),
    "stage_big_csv": _sql("s_artworks", f"""SELECT {_null_token_columns(_ARTWORK_COLUMNS, rules.NULL_TOKENS)}, TRUE AS from_csv_file
        FROM (SELECT * REPLACE ('say "hi"' || chr(10) || ', line ' || title AS title) FROM s_artworks) b"""),
    "stage_null_tokens": f"""SELECT p_partkey, CASE WHEN text IN ({_list(rules.NULL_TOKENS)}) THEN NULL ELSE text END AS text
        FROM (SELECT p_partkey, CASE WHEN p_partkey % {2 * len(rules.NULL_TOKENS)} < {len(rules.NULL_TOKENS)}
                THEN {_TOKENS}[CAST(p_partkey % {2 * len(rules.NULL_TOKENS)} + 1 AS int)] ELSE p_name END AS text FROM part) t""",
    "scan_project_filter": _sql("s_artworks", "SELECT object_id, title, credit_line, date_acquired FROM s_artworks WHERE title IS NOT NULL"),
    "filter_external_ids": _sql("with_id", "SELECT * FROM with_id"),
    "conform_schema": _sql("s_artworks", """SELECT CAST(object_id AS int) AS artwork_id, title, try_cast(height_cm AS double) AS height_cm,
        try_cast(width_cm AS double) AS width_cm, CAST(NULL AS double) AS depth_cm,
        CAST(try_strptime(date_acquired, '%Y-%m-%d') AS date) AS date_acquired,
        CASE WHEN regexp_full_match(substr(accession_number, 1, 3), '[0-9]+') THEN CAST(substr(accession_number, 1, 3) AS int) END AS creation_year
        FROM s_artworks"""),
    "conform_rejects": _sql("s_artworks", """SELECT unnest(['artwork_id', 'title', 'height_cm', 'width_cm', 'date_acquired', 'creation_year']) AS column_name,
        CAST(unnest([0, 0, count_if(height_cm = 'n/a'), 0, count_if(date_acquired = 'unknown'),
          count_if(NOT regexp_full_match(substr(accession_number, 1, 3), '[0-9]+'))]) AS bigint) AS rejected FROM s_artworks"""),
    "sink_roundtrip": _sql("t_artworks", "SELECT * FROM t_artworks"),
    "json_country_flatten": _sql("s_countries", f"""SELECT trim(country_name) AS country_name, country_code_iso2, country_code_iso3, continent,
        region, subregion, latitude, longitude, {_text(rules.COUNTRY_SOURCE)} AS source FROM s_countries"""),
    "json_observations": _sql("s_monthly", "SELECT 'CPI' AS series, make_date(year, month, 1) AS observed_on, value FROM s_monthly WHERE month <> 6"),
    "json_bindings_flatten": _sql("s_bindings", """SELECT DISTINCT qid, movement, education, influenced_by, birth_place, birth_place_country,
        death_place, bio_text FROM s_bindings"""),
    "parse_creation_date": _sql("dated", "SELECT object_id, date, creation_year, date_certainty FROM dated"),
    "parse_dimensions": _sql("measured", "SELECT * FROM measured"),
    "parse_acquisition_date": _sql("s_artworks", """SELECT object_id, d AS date_acquired, CAST(year(d) AS int) AS acquisition_year
        FROM (SELECT object_id, CAST(try_strptime(date_acquired, '%Y-%m-%d') AS date) AS d FROM s_artworks) a"""),
    "classify_acquisition_method": _sql("t_artworks", "SELECT CAST(artwork_id AS string) AS object_id, acquisition_method FROM t_artworks"),
    "artwork_quality_score": _sql("t_artworks", "SELECT artwork_id, data_quality_score FROM t_artworks"),
    "clean_year": _sql("t_artists", "SELECT CAST(artist_id AS string) AS constituent_id, birth_year, death_year, is_living, lifespan_years FROM t_artists"),
    "standardize_gender": _sql("t_artists", "SELECT CAST(artist_id AS string) AS constituent_id, gender_clean FROM t_artists"),
    "artist_quality_score": _sql("t_artists", "SELECT artist_id, data_quality_score FROM t_artists"),
    "assign_era": _sql("t_artworks", f"SELECT artwork_id, {_era('creation_year')} AS era FROM t_artworks"),
    "date_parts": _sql("t_artworks", """SELECT artwork_id, CAST(floor(creation_year / 10) * 10 AS int) AS decade, CAST(floor(creation_year / 100) AS int) AS century,
        CAST(creation_year * 10000 + 101 AS int) AS date_key, make_date(creation_year, 1, 1) AS full_date FROM t_artworks"""),
    "nationality_map": _sql("geo_reference", "SELECT * FROM geo_reference"),
    "customer_nationality": f"""SELECT c_custkey, {_nationality('country')} AS nationality
        FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 < 5 THEN {_COUNTRY_NAMES}[CAST(c_custkey % 10 + 1 AS int)]
                ELSE 'Land ' || c_mktsegment END AS country FROM customer) c""",
    "fetch_status": _sql("part_enriched", "SELECT artist_name, wikidata_id, fetch_status, has_response FROM part_enriched"),
    "fetch_status_single": _sql("requested collected", """SELECT r.display_name AS artist_name, r.wiki_qid AS wikidata_id, c.* EXCLUDE (qid),
        CASE WHEN no4 = 3 THEN 'failed' WHEN no5 = 0 THEN 'no_data' WHEN no7 IN (1, 2, 3) THEN 'failed' ELSE 'success' END AS fetch_status
        FROM (SELECT *, q % 4 AS no4, q % 5 AS no5, q % 7 AS no7 FROM (SELECT *, CAST(substr(wiki_qid, 2) AS int) AS q FROM requested) x) r
        LEFT JOIN collected c ON r.wiki_qid = c.qid AND no4 <> 3 AND no5 <> 0 AND no7 NOT IN (1, 2, 3)"""),
    "request_batches": _sql("requested", """SELECT no // 5 AS batch_no, count(*) AS ids, string_agg('wd:' || wiki_qid, ' ' ORDER BY wiki_qid) AS request_text
        FROM requested GROUP BY 1"""),
    "enrich_left_join": _sql("s_artists enriched", """SELECT constituent_id, wikidata_id, wikidata_id IS NOT NULL AS has_wikidata_enrichment,
        movements AS art_movements, education FROM s_artists a
        LEFT JOIN (SELECT * FROM enriched WHERE fetch_status = 'success') e ON a.wiki_qid = e.wikidata_id"""),
    "bindings_collect": _sql("s_bindings", f"""SELECT * FROM (
        WITH arrived AS (SELECT * REPLACE (pos % 2 * 10 + pos AS pos) FROM s_bindings) {_collected('arrived')}) c"""),
    "raw_responses": _sql("s_bindings", """SELECT batch_no, text AS api_response_json, md5(text) AS digest
        FROM (SELECT batch_no, if(batch_no % 3 = 0, ' ', '') || '{"n": ' || count(*) || '}' AS text
              FROM (SELECT CAST(substr(qid, 2) AS int) % 11 AS batch_no FROM s_bindings) b GROUP BY batch_no) t
        WHERE batch_no % 4 NOT IN (1, 2)"""),
    "enrichment_table": _sql("enriched", "SELECT * FROM enriched"),
    "year_spine_join": _sql("spine", """SELECT *, CAST(NULL AS double) AS unemployment_rate_percent, CAST(NULL AS double) AS sp500_close FROM spine"""),
    "annual_resample": _sql("s_monthly", "SELECT 'CPI' AS series, year, round(avg(value), 2) AS value FROM s_monthly WHERE month <> 6 GROUP BY year"),
    "pct_change": _sql("economics", "SELECT year, inflation_rate_percent FROM economics"),
    "year_classify": _sql("t_artworks", f"""SELECT artwork_id, creation_year, {_period('creation_year')} AS economic_period,
        {_event('creation_year')} AS major_events FROM t_artworks"""),
    "drop_all_duplicates": _sql("requested", "SELECT display_name, wiki_qid, nationality, begin_date, end_date FROM requested"),
    "keep_first_duplicate": """SELECT l_orderkey, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) l WHERE rn = 1""",
    "duplicate_profile": """SELECT count(*) AS repeated_keys, CAST(sum(n) AS bigint) AS rows_with_repeated_key,
        CAST(sum(n - 1) AS bigint) AS rows_dropped_by_keep_first FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) g WHERE n > 1""",
    "duplicate_examples": "SELECT l_orderkey, count(*) AS copies FROM lineitem GROUP BY 1 HAVING count(*) > 1 ORDER BY copies DESC, l_orderkey LIMIT 5",
    "artworks_transform": _sql("t_artworks", "SELECT * FROM t_artworks"),
    "artists_transform": _sql("t_artists", "SELECT * FROM t_artists"),
    "bridge_explode": _sql("listed", "SELECT * FROM listed"),
    "bridge_rejects": _sql("listed", "SELECT artwork_id, ' n.n.' AS listed_id FROM listed WHERE artist_id = 999999"),
    "bridge_build": _sql("bridge", "SELECT * FROM bridge"),
    "artist_stats_update": _sql("a_stats", "SELECT artist_id, display_name, total_artworks_in_collection, first_acquisition_year, last_acquisition_year FROM a_stats"),
    "geography_transform": _sql("t_geography", "SELECT * FROM t_geography"),
    "economics_build": _sql("economics", f"SELECT *, {_text(rules.ECONOMIC_SOURCE)} AS source FROM economics"),
    "date_economics": _sql("calendar", "SELECT * FROM calendar"),
    "dim_date": _sql("calendar", "SELECT * FROM calendar"),
    "dim_geography": _sql("t_geography", "SELECT * FROM t_geography"),
    "dim_artist": _sql("d_artist", "SELECT * FROM d_artist"),
    "dim_artwork": _sql("d_artwork", "SELECT * FROM d_artwork"),
    "fact_acquisitions": _sql("fact", "SELECT * FROM fact"),
    "fact_artist_summary": _sql("summary", "SELECT * FROM summary"),
    "surrogate_key": _sql("fact", "SELECT acquisition_key, artwork_id, artist_id FROM fact"),
    "movement_explode": _sql("d_artist", "SELECT movement, count(*) AS artists FROM (SELECT unnest(string_split(art_movements, '|')) AS movement FROM d_artist) m GROUP BY 1"),
    "gate_row_counts": _sql("t_artworks t_artists bridge", " UNION ALL ".join(
        _gate(f"{name} has at least {least} rows", f"SELECT greatest({least} - count(*), 0) FROM {source}")
        for (name, least), source in zip(rules.MINIMUM_ROWS.items(), ("t_artworks", "t_artists", "bridge")))),
    "gate_unique": _sql("bridge fact s_artists", " UNION ALL ".join((
        _gate("bridge unique (artwork_id, artist_id)", _repeated("bridge", "artwork_id, artist_id")),
        _gate("acquisitions unique (acquisition_key)", _repeated("fact", "acquisition_key")),
        _gate("artists unique (wiki_qid)", _repeated("s_artists", "wiki_qid"))))),
    "gate_fk": _sql("bridge t_artworks s_artists listed", " UNION ALL ".join((
        _gate("bridge to artists", "SELECT count(*) FROM bridge WHERE artist_id NOT IN (SELECT CAST(constituent_id AS int) FROM s_artists)"),
        _gate("bridge to artworks", "SELECT count(*) FROM bridge WHERE artwork_id NOT IN (SELECT artwork_id FROM t_artworks)"),
        _gate("listed ids to artists", "SELECT count(*) FROM listed WHERE artist_id NOT IN (SELECT CAST(constituent_id AS int) FROM s_artists)")))),
    "gate_not_null": _sql("t_artworks", " UNION ALL ".join(
        _gate(f"artworks.{name} not null", f"SELECT count(*) FROM t_artworks WHERE {name} IS NULL")
        for name in ("artwork_id", "title", "creation_year", "date_acquired"))),
    "gate_declared": _sql("calendar t_geography d_artist d_artwork fact summary", " UNION ALL ".join(
        [_gate(f"{name} unique ({key})", _repeated(source, key)) for name, source, key in (
            ("dim_date", "calendar", "date_key"), ("dim_date", "calendar", "full_date"), ("dim_geography", "t_geography", "nationality"),
            ("dim_artist", "d_artist", "artist_id"), ("dim_artwork", "d_artwork", "artwork_id"),
            ("fact_artwork_acquisitions", "fact", "acquisition_key"), ("fact_artist_summary", "summary", "artist_summary_key"),
            ("fact_artist_summary", "summary", "artist_id, snapshot_date"))]
        + [_gate(f"{name}.{column} not null", f"SELECT count(*) FROM {source} WHERE {column} IS NULL") for name, source, columns in (
            ("dim_date", "calendar", "date_key full_date year decade century"), ("dim_geography", "t_geography", "nationality country_name"),
            ("dim_artist", "d_artist", "artist_id display_name"), ("dim_artwork", "d_artwork", "artwork_id"),
            ("fact_artwork_acquisitions", "fact", "acquisition_key artwork_id artist_id"),
            ("fact_artist_summary", "summary", "artist_summary_key artist_id snapshot_date"))
           for column in columns.split()]
        + [_gate(f"{child}.{column} in {parent}",
                 f"SELECT count(*) FROM {rows} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {source})")
           for child, rows, column, parent, source, key in (
            ("fact_artwork_acquisitions", "fact", "artwork_id", "dim_artwork", "d_artwork", "artwork_id"),
            ("fact_artwork_acquisitions", "fact", "artist_id", "dim_artist", "d_artist", "artist_id"),
            ("fact_artwork_acquisitions", "fact", "acquisition_date_key", "dim_date", "calendar", "date_key"),
            ("fact_artwork_acquisitions", "fact", "creation_date_key", "dim_date", "calendar", "date_key"),
            ("fact_artist_summary", "summary", "artist_id", "dim_artist", "d_artist", "artist_id"))])),
    "load_rejects": _sql("s_ids", """SELECT 'staging_artworks' AS table_name, 'no key' AS reason, count_if(k % 11 = 0) AS n FROM spoilt
        UNION ALL SELECT 'staging_artworks', 'repeated key', greatest(count_if(huge) - 1, 0) FROM spoilt
        UNION ALL SELECT 'transformed_artworks', 'bad key', count_if(k % 11 <> 0 AND k % 13 = 0) + least(count_if(huge), 1) FROM spoilt
        UNION ALL SELECT 'bridge_artwork_artist', 'bad list id', count_if(k % 17 = 0 AND k % 10 <> 0) FROM spoilt""").replace(
        "\nSELECT 'staging", """, spoilt AS (SELECT k, k % 17 = 0 AND k % 11 <> 0 AND k % 13 <> 0 AS huge
            FROM (SELECT CAST(object_id AS bigint) AS k FROM s_ids) o)
        SELECT 'staging"""),
    "rejected_rows": _sql("s_artworks s_artists listed", """
        SELECT 'transformed_artworks' AS table_name, id AS row_key, u.column_name, u.raw_value, u.reason
        FROM (SELECT CASE WHEN CAST(object_id AS bigint) % 13 = 0 THEN 'x' || object_id ELSE object_id END AS id, * FROM s_artworks) a,
          LATERAL (VALUES ('object_id', CASE WHEN starts_with(id, 'x') THEN id END, 'bad key'), ('height_cm', CASE WHEN height_cm = 'n/a' THEN 'n/a' END, 'no number'),
            ('date_acquired', CASE WHEN date_acquired = 'unknown' THEN 'unknown' END, 'no date')) u(column_name, raw_value, reason)
        WHERE u.raw_value IS NOT NULL
        UNION ALL SELECT 'transformed_artists', constituent_id, 'begin_date', begin_date, 'no year' FROM s_artists WHERE begin_date = 'abc'
        UNION ALL SELECT 'bridge_artwork_artist', CAST(artwork_id AS string), 'constituent_id', IF(artwork_id % 34 = 17, ' n.n.', '999999'),
          IF(artwork_id % 34 = 17, 'bad list id', 'unknown artist') FROM listed WHERE artist_id = 999999"""),
    "load_stamps": _sql("economics t_artworks d_artist", """
        SELECT 'staging_economics' AS table_name, 'loaded_at' AS column_name, count(*) AS n, CAST(1 AS bigint) AS times, '2005-01-01 00:00:00' AS stamp FROM economics
        UNION ALL SELECT 'transformed_artworks', 'transformed_at', count(*), 1, '2005-01-01 00:00:00' FROM t_artworks
        UNION ALL SELECT 'dim_artist', 'created_at', count(*), 1, '2005-01-01 00:00:00' FROM d_artist"""),
    "report_table_counts": _sql("calendar t_geography d_artist d_artwork fact summary", """SELECT (SELECT count(*) FROM calendar) AS date_records,
        (SELECT count(*) FROM t_geography) AS geography_records, (SELECT count(*) FROM d_artist) AS artist_records,
        (SELECT count(*) FROM d_artwork) AS artwork_records, (SELECT count(*) FROM fact) AS acquisitions,
        (SELECT count(*) FROM summary) AS artist_summaries"""),
    "report_transformed_counts": _sql("t_artworks t_artists t_geography calendar bridge", """SELECT (SELECT count(*) FROM t_artworks) AS artworks,
        (SELECT count(*) FROM t_artists) AS artists, (SELECT count(*) FROM t_geography) AS geography,
        (SELECT count(*) FROM calendar) AS date_economics, (SELECT count(*) FROM bridge) AS bridge"""),
    "report_samples": _sql("s_artworks", "SELECT object_id, title FROM s_artworks WHERE title IS NOT NULL ORDER BY CAST(object_id AS bigint) LIMIT 5"),
    "report_name_samples": _sql("s_artists", "SELECT display_name FROM s_artists WHERE display_name IS NOT NULL ORDER BY 1 LIMIT 5"),
    "report_country_samples": _sql("geo_reference", """SELECT country_name, country_code_iso2, continent, region, nationality
        FROM geo_reference ORDER BY country_name LIMIT 10"""),
    "report_influence_samples": _sql("enriched", """SELECT artist_name, influenced_by FROM enriched
        WHERE influenced_by IS NOT NULL ORDER BY artist_name LIMIT 10"""),
    "report_staging_counts": _sql("s_artworks s_artists", """SELECT 'staging_artworks' AS table_name, count(*) AS n FROM s_artworks
        UNION ALL SELECT 'staging_artists', count(*) FROM s_artists"""),
    "report_movement_samples": _sql("enriched", """SELECT artist_name, movements, birth_place, birth_place_country FROM enriched
        WHERE movements IS NOT NULL ORDER BY artist_name LIMIT 10"""),
    "report_category_counts": _counts("geo_reference", "continent"),
    "report_date_certainty": _counts("t_artworks", "date_certainty"),
    "report_acquisition_methods": _counts("t_artworks", "acquisition_method"),
    "report_completeness": _sql("enriched", "SELECT count(*) AS total, " + ", ".join(
        [f"count({name}) AS has_{name}" for name in _DETAILS]
        + [f"round(count({name}) * 100.0 / count(*), 1) AS pct_{name}" for name in ("movements", "bio_text", "birth_place")]) + " FROM enriched"),
    "report_economics_completeness": _sql("economics", "SELECT count(*) AS total, " + ", ".join(
        f"count({name}) AS has_{name}" for name in ("gdp_usd_billions", "inflation_rate_percent", "unemployment_rate_percent", "sp500_close")) + " FROM economics"),
    "report_bridge_coverage": _sql("bridge", """SELECT count(*) AS relationships, count(DISTINCT artwork_id) AS artworks_with_artists,
        count(DISTINCT artist_id) AS artists_with_artworks FROM bridge"""),
    "report_by_continent": _sql("t_geography", """SELECT continent, count(*) AS n, CAST(sum(total_artists) AS bigint) AS total_artists
        FROM t_geography WHERE continent IS NOT NULL GROUP BY 1"""),
    "report_top_geography": _sql("t_geography", """SELECT nationality, country_name, continent, total_artists, total_artworks FROM t_geography
        WHERE total_artists > 0 ORDER BY total_artists DESC, nationality LIMIT 10"""),
    "report_quality_tiers": _tiers("t_artists"),
    "report_artwork_tiers": _tiers("t_artworks"),
    "report_collaborations": _sql("bridge", """FROM (SELECT artwork_id, CAST(len(list(artist_id)) AS bigint) AS artist_count FROM bridge GROUP BY ALL)
        WHERE artist_count >= 2 QUALIFY row_number() OVER (ORDER BY artist_count DESC, artwork_id) <= 10"""),
    "report_prolific": _sql("bridge t_artworks t_artists", """
        WITH per_artist AS (SELECT artist_id, list(acquisition_year) AS years FROM bridge JOIN t_artworks USING (artwork_id) GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (ORDER BY len(years) DESC, artist_id) AS place FROM per_artist)
        SELECT (SELECT display_name FROM t_artists p WHERE p.artist_id = ranked.artist_id) AS display_name,
          CAST(len(years) AS int) AS total_artworks_in_collection, list_min(years) AS first_acquisition_year, list_max(years) AS last_acquisition_year
        FROM ranked WHERE place <= 10"""),
    "report_pct_of_total": _shares("t_artworks", "classification", 1, "LIMIT 10"),
    "report_gender_shares": _shares("t_artists", "gender_clean"),
    "report_enrichment_shares": _shares("t_artists", "has_wikidata_enrichment"),
    "report_status_shares": _shares("part_enriched", "fetch_status", 2),
    "report_top_nationalities": _sql("t_artists", """SELECT nationality, count(*) AS artist_count FROM t_artists WHERE nationality <> 'Unknown'
        GROUP BY 1 ORDER BY artist_count DESC, nationality LIMIT 10"""),
    "report_era_distribution": _sql("calendar", "SELECT era, count(*) AS years, min(year) AS start_year, max(year) AS end_year FROM calendar GROUP BY era"),
    "report_calendar_summary": _sql("calendar", """SELECT min(year) AS first_year, max(year) AS last_year,
        count(DISTINCT economic_period) AS economic_periods, count(DISTINCT era) AS eras FROM calendar"""),
    "report_war_or_recession": _sql("calendar", "SELECT year, era, economic_period FROM calendar WHERE era IN ('WWI', 'WWII') OR economic_period = 'Recession'"),
    "report_recession_years": _sql("economics", """SELECT year, economic_period, major_events FROM economics
        WHERE economic_period = 'Recession' ORDER BY year DESC LIMIT 10"""),
    "report_chosen_years": _sql("economics", """SELECT year, gdp_usd_billions, inflation_rate_percent, economic_period FROM economics
        WHERE year IN (1994, 1996, 1998, 2000)"""),
    "report_artist_movements": _sql("d_artist t_geography summary", """
        WITH large AS (FROM summary WHERE total_artworks > 20 QUALIFY row_number() OVER (ORDER BY total_artworks DESC, artist_id) <= 10),
        countries AS (SELECT map_from_entries(list((nationality, country_name))) AS of FROM t_geography)
        SELECT display_name, of[p.nationality] AS country_name, art_movements, large.total_artworks
        FROM countries, large JOIN d_artist p USING (artist_id)"""),
    "analytics_top_artists": _sql("fact d_artist t_geography", """
        WITH works AS (SELECT histogram(artist_id) AS of FROM fact),
        placed AS (
          SELECT display_name, country_name, of[artist_id] AS n FROM works, d_artist JOIN t_geography USING (nationality) WHERE of[artist_id] IS NOT NULL)
        FROM (SELECT display_name, country_name, CAST(sum(n) AS bigint) AS artworks FROM placed GROUP BY ALL)
        QUALIFY row_number() OVER (ORDER BY artworks DESC, display_name, country_name) <= 10"""),
    "analytics_recession_acquisitions": _sql("fact calendar", """
        SELECT CAST(acquisition_date_key // 10000 AS int) AS year, 'Recession' AS economic_period, count(*) AS acquisitions FROM fact
        WHERE acquisition_date_key IN (SELECT date_key FROM calendar WHERE economic_period = 'Recession') GROUP BY acquisition_date_key"""),
    "sticky_batches": _sql("requested", """
        WITH ids AS (SELECT wiki_qid AS wikidata_id, CAST(substr(wiki_qid, 2) AS int) AS k FROM requested),
        before AS (SELECT wikidata_id, (row_number() OVER (ORDER BY md5(wikidata_id), wikidata_id) - 1) // 5 AS batch_no FROM ids WHERE k % 7 <> 3),
        kept AS (SELECT wikidata_id, batch_no FROM ids JOIN before USING (wikidata_id) WHERE k % 11 <> 4),
        gaps AS (
          SELECT batch_no, row_number() OVER (ORDER BY batch_no) AS place
          FROM (SELECT b.batch_no, unnest(range(5 - count(kept.batch_no))) FROM (SELECT DISTINCT batch_no FROM before) b LEFT JOIN kept USING (batch_no) GROUP BY b.batch_no)),
        fresh AS (
          SELECT wikidata_id, row_number() OVER (ORDER BY md5(wikidata_id), wikidata_id) AS place FROM ids
          WHERE k % 11 <> 4 AND wikidata_id NOT IN (SELECT wikidata_id FROM before))
        SELECT wikidata_id, batch_no FROM kept
        UNION ALL SELECT wikidata_id, coalesce(g.batch_no, (SELECT max(batch_no) + 1 FROM before) + (f.place - 1 - (SELECT count(*) FROM gaps)) // 5)
        FROM fresh f LEFT JOIN gaps g USING (place)"""),
    "series_change": """
        WITH sums AS (
          SELECT 'N' || c_nationkey AS series, CAST(year(o_orderdate) AS int) AS year, CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS double) AS value
          FROM orders JOIN customer ON o_custkey = c_custkey WHERE (year(o_orderdate) + c_nationkey) % 5 <> 0 GROUP BY c_nationkey, year(o_orderdate)),
        every AS (SELECT series, CAST(unnest(range(min(year), max(year) + 1)) AS int) AS year FROM sums GROUP BY series),
        filled AS (
          SELECT series, year, value, last_value(value IGNORE NULLS) OVER (PARTITION BY series ORDER BY year) AS f FROM every LEFT JOIN sums USING (series, year))
        SELECT series, year, value, round((f / lag(f) OVER (PARTITION BY series ORDER BY year) - 1) * 100, 4) AS change_percent FROM filled""",
    "year_ranges": _sql("t_artworks", """
        SELECT artwork_id, department, creation_year, EXISTS (
          SELECT 1 FROM supplier WHERE ['Drawings', 'Prints', 'Film'][CAST(s_suppkey % 3 + 1 AS int)] = department
            AND creation_year BETWEEN 1900 + s_suppkey * 37 % 100 AND 1900 + s_suppkey * 37 % 100 + s_nationkey % 4 - 1) AS in_range
        FROM t_artworks"""),
    "stats_partitions": _sql("bridge t_artworks", """
        SELECT artist_id, CAST(count(*) AS int) AS total_artworks_in_collection, min(acquisition_year) AS first_acquisition_year,
          max(acquisition_year) AS last_acquisition_year FROM bridge JOIN t_artworks USING (artwork_id) GROUP BY artist_id"""),
}
