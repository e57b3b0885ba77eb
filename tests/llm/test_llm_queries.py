"""Queries that SQL can express, against their comparison SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from starhouse.llm.registry import LLM_ORACLE, LLM_QUERIES

SF_DIR = "/root/testdata/sf0.01"


def rows(table, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(round(x[k], 9) if isinstance(x[k], float) else x[k] for k in order) for x in table), key=repr)


@pytest.mark.parametrize("name", list(LLM_ORACLE))
def test_query_agrees_with_sql(spark, name):
    connection = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    result = connection.execute(LLM_ORACLE[name])
    names = [x[0] for x in result.description]
    expected = rows(result.fetchall(), names)
    found = LLM_QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(names)
    assert expected and rows(map(tuple, found.collect()), found.columns) == expected


def test_every_operator_has_a_query():
    assert {x.split("_")[0] for x in LLM_QUERIES} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}
