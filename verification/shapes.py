"""The given tables brought into the shapes of the warehouse inputs.

Every shape is SQL over the tables named in braces.  Most texts run unchanged in Spark and in the
comparison engine; where the dialects differ there are two.  All rows of the tables are used.
"""

from __future__ import annotations

ARTWORKS = """
SELECT CAST(k AS string) AS object_id,
  CASE WHEN k % 50 = 0 THEN NULL ELSE 'Work ' || CAST(k AS string) END AS title,
  CASE CAST(k % 12 AS int)
    WHEN 0 THEN 'c. ' || y WHEN 1 THEN 'ca. ' || y WHEN 2 THEN 'published ' || y
    WHEN 3 THEN 'early ' || y WHEN 4 THEN 'March 3, ' || y WHEN 5 THEN y2 || '-' || y
    WHEN 6 THEN y2 || '-' || substr(y, 3, 2) WHEN 7 THEN ' ' || y || ' ' WHEN 8 THEN 'n.d.'
    WHEN 10 THEN 'c. unknown' WHEN 11 THEN '0999' END AS date,
  CASE CAST(k % 6 AS int)
    WHEN 0 THEN '12 x 8 1/2" (' || h || ' x ' || w || ' cm)'
    WHEN 1 THEN '(' || h || ' x ' || w || ' x 3.5 cm)' WHEN 2 THEN 'variable, cm'
    WHEN 4 THEN h || ' x ' || w || ' CM' WHEN 5 THEN '5 cm' END AS dimensions,
  CASE CAST(k % 4 AS int) WHEN 0 THEN h WHEN 1 THEN 'n/a' END AS height_cm,
  CASE CAST(k % 5 AS int) WHEN 0 THEN w END AS width_cm,
  CASE CAST(k % 9 AS int)
    WHEN 0 THEN 'Gift of the artist' WHEN 1 THEN 'Louis E. Stern Collection'
    WHEN 2 THEN 'Given anonymously' WHEN 3 THEN 'Purchase' WHEN 4 THEN 'Gift and purchase'
    WHEN 5 THEN 'Bequest of X (by exchange)' WHEN 6 THEN 'Bequest of Y'
    WHEN 7 THEN 'Mrs. Z Fund' END AS credit_line,
  CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 = 1 THEN 'unknown' ELSE d END AS date_acquired,
  CASE CAST(k % 3 AS int) WHEN 0 THEN 'Y' WHEN 1 THEN 'n' END AS cataloged,
  CASE WHEN k % 13 = 0 THEN '(not assigned)' ELSE p END AS classification,
  'medium ' || CAST(CAST(k % 4 AS int) AS string) AS medium,
  CASE WHEN st = 'F' THEN 'Drawings' WHEN st = 'O' THEN 'Prints' ELSE 'Film' END AS department,
  CAST(CAST(k % 1000 AS int) AS string) || '.' || substr(d, 1, 4) AS accession_number,
  'http://x/' || CAST(k AS string) AS url,
  CASE WHEN k % 7 > 2 THEN 'http://x/' || CAST(k AS string) || '.jpg' END AS image_url
FROM (SELECT o_orderkey AS k, o_orderpriority AS p, o_orderstatus AS st,
        CAST(CAST(o_orderdate AS date) AS string) AS d,
        CAST(CAST(year(o_orderdate) AS int) - CAST(o_orderkey % 90 AS int) AS string) AS y,
        CAST(CAST(year(o_orderdate) AS int) - CAST(o_orderkey % 90 AS int) - CAST(o_orderkey % 7 AS int) - 1 AS string) AS y2,
        CAST(CAST(o_orderkey % 40 AS int) + 10 AS string) || '.5' AS h,
        CAST(CAST(o_orderkey % 30 AS int) + 5 AS string) AS w
      FROM {orders}) b
"""

# External ids repeat in pairs, nationalities are padded and in mixed case.
ARTISTS = """
SELECT CAST(s_suppkey + 1 AS string) AS constituent_id, s_name AS display_name,
  CASE CAST(s_suppkey % 5 AS int) WHEN 0 THEN ' ' || lower(n_name) || 'ian ' WHEN 1 THEN upper(n_name) || 'IAN'
    WHEN 4 THEN NULL ELSE n_name || 'ian' END AS nationality,
  CASE CAST(s_suppkey % 8 AS int) WHEN 0 THEN 'male' WHEN 1 THEN 'M' WHEN 2 THEN '(Female)' WHEN 3 THEN ' f '
    WHEN 4 THEN 'Non-Binary' WHEN 5 THEN 'other' WHEN 6 THEN '' END AS gender,
  CASE CAST(s_suppkey % 6 AS int) WHEN 0 THEN '0' WHEN 1 THEN 'abc'
    ELSE CAST(CAST(1880 + s_suppkey % 100 AS int) AS string) || CASE WHEN s_suppkey % 2 = 0 THEN '.7' ELSE '' END END AS begin_date,
  CASE CAST(s_suppkey % 4 AS int) WHEN 0 THEN '0' WHEN 1 THEN NULL
    ELSE CAST(CAST(1940 + s_suppkey % 80 AS int) AS string) END AS end_date,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'Q' || CAST(CAST(floor(s_suppkey / 2) AS int) AS string) END AS wiki_qid
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
"""

# One row per artwork; every 10th lists nobody, every 17th also lists an unknown artist.
ARTWORK_IDS_SPARK = """
SELECT CAST(l_orderkey AS string) AS object_id,
  CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE
    array_join(transform(sort_array(collect_set(l_suppkey + 1)), x -> CAST(x AS string)), ', ')
    || CASE WHEN l_orderkey % 17 = 0 THEN ', 999999' ELSE '' END END AS constituent_id
FROM {lineitem} GROUP BY l_orderkey
"""
ARTWORK_IDS_ORACLE = """
SELECT CAST(l_orderkey AS string) AS object_id,
  CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE
    string_agg(CAST(a AS string), ', ' ORDER BY a)
    || CASE WHEN l_orderkey % 17 = 0 THEN ', 999999' ELSE '' END END AS constituent_id
FROM (SELECT DISTINCT l_orderkey, l_suppkey + 1 AS a FROM {lineitem}) GROUP BY l_orderkey
"""

_BINDING_COLUMNS = """
SELECT qid, pos,
  CASE WHEN pos % 2 = 0 THEN 'Movement ' || CAST(CAST((k + pos) % 4 AS int) AS string) END AS movement,
  CASE WHEN k % 3 = 0 THEN 'School ' || CAST(CAST(pos % 3 AS int) AS string) END AS education,
  CASE WHEN pos > 1 THEN 'Master ' || CAST(CAST(k % 5 AS int) AS string) END AS influenced_by,
  CASE WHEN k % 4 <> 0 THEN 'Town ' || CAST(CAST((k + pos) % 6 AS int) AS string) END AS birth_place,
  CASE WHEN k % 5 = 0 THEN 'Country ' || CAST(CAST(k % 6 AS int) AS string) END AS birth_place_country,
  CASE WHEN k % 2 = 0 THEN 'Town ' || CAST(CAST(k % 7 AS int) AS string) END AS death_place,
  CASE WHEN k % 7 <> 0 THEN 'bio ' || qid END AS bio_text
FROM (
"""
BINDINGS_SPARK = _BINDING_COLUMNS + """
  SELECT k, 'Q' || CAST(k AS string) AS qid, explode(sequence(0, 3)) AS pos
  FROM (SELECT DISTINCT CAST(floor(s_suppkey / 2) AS int) AS k FROM {supplier}) i) b
"""
BINDINGS_ORACLE = _BINDING_COLUMNS + """
  SELECT k, 'Q' || CAST(k AS string) AS qid, CAST(unnest([0, 1, 2, 3]) AS int) AS pos
  FROM (SELECT DISTINCT CAST(floor(s_suppkey / 2) AS int) AS k FROM {supplier}) i) b
"""

# ISO-2 codes repeat. The list is in no alphabetical order: of 25 countries, every 7th.
COUNTRIES = """
SELECT ' ' || n_name AS country_name, 'N' || CAST(n_nationkey % 20 AS string) AS country_code_iso2,
  'NX' || CAST(n_nationkey AS string) AS country_code_iso3, r_name AS continent, r_name AS region,
  CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE r_name || ' sub' END AS subregion,
  CAST(n_nationkey AS double) AS latitude, CAST(-n_nationkey AS double) AS longitude, CAST(n_nationkey * 7 % 25 AS int) AS listed
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

# The value of 1998 is missing in the second series, that of 1999 in both.
SERIES = """
SELECT year, CASE WHEN year = 1999 THEN NULL ELSE gdp END AS gdp,
  CASE WHEN year IN (1998, 1999) THEN NULL ELSE cpi END AS cpi
FROM (SELECT CAST(year(o_orderdate) AS int) AS year, CAST(sum(CAST(o_totalprice AS decimal(18,2))) AS decimal(18,2)) AS gdp,
        round(CAST(avg(CAST(o_totalprice AS decimal(18,2))) AS double), 2) AS cpi FROM {orders} GROUP BY 1) z
"""

# Dates per month, for the yearly resampling.
MONTHLY = """
SELECT CAST(year(o_orderdate) AS int) AS year, CAST(month(o_orderdate) AS int) AS month,
  round(CAST(avg(CAST(o_totalprice AS decimal(18,2))) AS double), 2) AS value
FROM {orders} GROUP BY 1, 2
"""

SPINE = (1993, 2003)

SPARK = {
    "artworks": ARTWORKS, "artists": ARTISTS, "artwork_ids": ARTWORK_IDS_SPARK, "bindings": BINDINGS_SPARK,
    "countries": COUNTRIES, "series": SERIES, "monthly": MONTHLY,
}
ORACLE = SPARK | {"artwork_ids": ARTWORK_IDS_ORACLE, "bindings": BINDINGS_ORACLE}
_TABLES = ("region", "nation", "supplier", "orders", "lineitem")


def tables_of(name: str) -> list[str]:
    return [table for table in _TABLES if "{" + table + "}" in SPARK[name]]


def oracle_shape(name: str) -> str:
    return ORACLE[name].format(**{table: table for table in _TABLES}).strip()
