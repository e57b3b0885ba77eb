"""The license scan's query over ``documents``, and its comparison SQL: every window against every license, exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starhouse.llm.common import table
from starhouse.llm.licenses import LICENSES, PERCENT, scan


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


_LISTED = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in LICENSES)
_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
_SHINGLES = "list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])"

ORACLE = f"""
WITH listed(license, text) AS (VALUES {_LISTED}),
known AS (
  SELECT license, greatest(4, pow(2, ceil(log2(len(w)))))::INT AS length, list_distinct({_SHINGLES}) AS own
  FROM (SELECT license, {_WORDS} AS w FROM listed)),
piece AS (
  SELECT doc_id, unnest(range(len(s))) AS place, unnest(s) AS shingle
  FROM (SELECT doc_id, {_SHINGLES} AS s FROM (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL) WHERE len(w) >= 3)),
wanted AS (SELECT license, length, len(own) AS n, unnest(own) AS shingle FROM known),
met AS (SELECT doc_id, license, length, n, place, shingle FROM piece JOIN wanted USING (shingle)),
inside AS (
  SELECT doc_id, license, n, length, w AS number, shingle
  FROM met, (VALUES (0), (1)) AS back(b), LATERAL (SELECT place // length - b AS w)
  WHERE w >= 0 AND place < w * length + 2 * length - 2),
counted AS (SELECT doc_id, license, n, number, count(DISTINCT shingle) AS n_common FROM inside GROUP BY ALL)
SELECT doc_id, license, max(n_common) AS n_common, max(n_common / n) AS containment
FROM counted WHERE 100 * n_common >= {PERCENT} * n GROUP BY doc_id, license
"""
