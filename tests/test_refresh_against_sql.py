"""Tables of a full refresh on landed shapes against the comparison SQL."""

from __future__ import annotations

import pytest
from conftest import SF_DIR

from starhouse.plans.refresh import run_refresh
from starhouse.sources.tables import read_table
from verification.compare import normalised, oracle_connection
from verification.landed import land_inputs
from verification.oracle import ORACLE
from verification.shapes import SPINE
from verification.warehouse import SNAPSHOT, presentable


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    sources = land_inputs(spark, SF_DIR, str(tmp_path_factory.mktemp("shapes") / "in"))
    target = str(tmp_path_factory.mktemp("refreshed"))
    run_refresh(spark, sources, target, SNAPSHOT, {"bridge_artwork_artist": 1}, SPINE)
    return target


@pytest.mark.parametrize(("table", "query"), [
    ("transformed_artworks", "artworks_transform"), ("bridge_artwork_artist", "bridge_build"), ("dim_artist", "dim_artist"),
    ("dim_artwork", "dim_artwork"), ("transformed_geography", "geography_transform"), ("dim_geography", "dim_geography"),
    ("staging_geography", "nationality_map"), ("fact_artwork_acquisitions", "fact_acquisitions"), ("fact_artist_summary", "fact_artist_summary"),
])
def test_refreshed_table_agrees_with_sql(spark, root, table, query):
    mine = presentable(read_table(spark, root, table))
    result = oracle_connection(SF_DIR).execute(ORACLE[query])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(mine.columns)
    assert normalised(mine.collect(), mine.columns) == normalised(result.fetchall(), names)
