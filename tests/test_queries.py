"""Every registered query against its comparison SQL on the smallest tables."""

from __future__ import annotations

import pytest
from conftest import SF_DIR

import __spark_entry__
from verification.compare import compare, oracle_connection
from verification.oracle import ORACLE
from verification.queries import QUERIES


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name) is None


def test_every_query_has_comparison_sql():
    assert set(ORACLE) == set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).columns == ["display_name", "country_name", "artworks"]
