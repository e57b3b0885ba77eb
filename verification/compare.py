"""Run registered queries in Spark and in DuckDB side by side: ``python -m verification.compare [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

from starhouse.session import build_session
from verification.oracle import ORACLE
from verification.queries import QUERIES, query


def normalised(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(cell):
        if isinstance(cell, float):
            return None if math.isnan(cell) else round(cell, 6)
        return cell

    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


def oracle_connection(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def compare(spark, connection, sf_dir: str, name: str) -> str | None:
    """None when both engines agree on columns and rows, else what differs."""
    frame = query(QUERIES[name])(spark, sf_dir)
    mine = normalised(frame.collect(), frame.columns)
    if name not in ORACLE:
        return None
    result = connection.execute(ORACLE[name])
    columns = [column[0] for column in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    theirs = normalised(result.fetchall(), columns)
    if mine != theirs:
        only_mine = [row for row in mine if row not in theirs][:3] if len(mine) < 5000 else []
        only_theirs = [row for row in theirs if row not in mine][:3] if len(mine) < 5000 else []
        first = next(((a, b) for a, b in zip(mine, theirs) if a != b), None)
        return f"{len(mine)} against {len(theirs)} rows; {only_mine} / {only_theirs}; first difference {first}"
    return None


def main(arguments: list[str]) -> int:
    sf = arguments[0] if arguments else "0.01"
    names = arguments[1:] or list(QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    wrong = 0
    for name in names:
        start = time.perf_counter()
        try:
            difference = compare(spark, connection, sf_dir, name)
        except Exception as error:
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        wrong += difference is not None
        print(f"{'ok ' if difference is None else 'BAD'} {name} {time.perf_counter() - start:.2f}s {difference or ''}", flush=True)
    print(f"{len(names) - wrong} of {len(names)} agree")
    return 1 if wrong else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
