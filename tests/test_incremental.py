"""Operators on landed ranges, earlier requests and written parts, and gates in one pass."""

from __future__ import annotations

import random
from collections import Counter
from pathlib import Path

from conftest import values
from pyspark.sql import functions as F

from starhouse import schemas
from starhouse.operators import economics, intervals, numbering, quality
from starhouse.sources import partitions


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_flags_equal_comparing_everything(spark):
    rng = random.Random(2)
    ranges = [(rng.choice("ab"), a, a + rng.choice([-3, 0, 1, 7, 200])) for a in (rng.randrange(-500, 500) for _ in range(60))]
    ranges += [("a", 40, 41), ("a", 40, 41), ("a", 42, 50), ("b", None, 3), ("b", 3, None), (None, 1, 900)]
    rows = [(n, rng.choice("abc"), rng.randrange(-600, 900)) for n in range(1500)] + [(-1, "a", None), (-2, None, 5), (-3, "a", 40), (-3, "a", 40)]
    table = spark.createDataFrame(ranges, "kind string, first int, last int")
    df = spark.createDataFrame(rows, "n int, kind string, year int")
    expected = sorted(((n, k, y, y is not None and k is not None and any(
        kind == k and a is not None and b is not None and a <= y <= b for kind, a, b in ranges)) for n, k, y in rows), key=repr)
    for width in (1, 8, 1000):
        found = intervals.with_range_flag(df, "year", table, "inside", width, ["kind"])
        assert values(found, "n", "kind", "year", "inside") == expected
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    alone = intervals.with_range_flag(df, "year", table.where("kind = 'a'"), "inside", 8)
    assert alone.where("inside").count() == sum(y is not None and any(k == "a" and a <= y <= b for k, a, b in ranges if None not in (k, a, b)) for _, _, y in rows)


def test_only_changed_parts_are_written_again(spark, tmp_path):
    path = str(tmp_path / "t")

    def files():
        return {x.parent.name: (x.name, x.stat().st_mtime_ns) for x in Path(path).rglob("*.parquet")}

    first = spark.range(400).select("id", (F.col("id") % 7).alias("n"), F.lit("x").alias("s"))
    partitions.write_parts(first, path, "id", 16)
    before = files()
    assert partitions.update_parts(first.repartition(3), path, "id", 16, str(tmp_path / "a")) == [] and files() == before
    touched = first.withColumn("n", F.when(F.col("id").isin(5, 90), None).otherwise(F.col("n"))).where("id != 17").unionByName(
        spark.createDataFrame([(1000, 1, None)], "id long, n long, s string"))
    changed = partitions.update_parts(touched, path, "id", 16, str(tmp_path / "b"))
    after = files()
    assert 1 <= len(changed) <= 4 and {x for x in after if after[x] != before[x]} == {f"part={x}" for x in changed}
    assert values(partitions.read_parts(spark, path, touched), "*") == values(touched, "*")
    few = touched.where("id < 2")
    partitions.update_parts(few, path, "id", 16, str(tmp_path / "c"))
    assert values(partitions.read_parts(spark, path, few), "*") == values(few, "*") and len(files()) <= 2


def test_batches_stay_and_gaps_fill(spark, monkeypatch):
    monkeypatch.setattr(numbering, "_BATCHES", 2)  # several groups of batches
    old = numbering.with_request_batch(spark.range(103).select(F.concat(F.lit("Q"), "id").alias("qid")), "qid", 10)
    before = {row["qid"]: row["batch_no"] for row in old.collect()}
    ids = [f"Q{n}" for n in range(103) if n not in (3, 4, 50, 51, 52, 99)]
    for added in (0, 6, 13, 40):
        wanted = spark.createDataFrame([(x, "kept") for x in [*ids, *[f"N{n}" for n in range(added)]]], "qid string, row string")
        found = {row["qid"]: row["batch_no"] for row in numbering.sticky_batches(wanted, "qid", old, 10).collect()}
        assert len(found) == len(ids) + added and all(found[x] == before[x] for x in ids)
        sizes = Counter(found.values())
        assert max(sizes.values()) <= 10
        assert sorted(sizes) == list(range(max(sizes) + 1)) and sum(n < 10 for n in sizes.values()) <= max(1, 6 + 7 - added)
    empty = spark.createDataFrame([], "qid string, batch_no long")
    assert values(numbering.sticky_batches(old.select("qid"), "qid", empty, 10), "qid", "batch_no") == values(old, "qid", "batch_no")
    assert numbering.sticky_batches(old.select("qid").where("false"), "qid", old, 10).count() == 0


def test_series_have_their_own_years(spark):
    rows = [("a", 2000, 10.0), ("a", 2003, 20.0), ("b", 1990, 0.0), ("b", 1991, 5.0), ("c", 5, 1.0)]
    found = economics.series_change(spark.createDataFrame(rows, "series string, year int, value double"))
    assert values(found, "series", "year", "value", "change_percent") == sorted([
        ("a", 2000, 10.0, None), ("a", 2001, None, 0.0), ("a", 2002, None, 0.0), ("a", 2003, 20.0, 100.0),
        ("b", 1990, 0.0, None), ("b", 1991, 5.0, None), ("c", 5, 1.0, None)], key=repr)
    assert "SinglePartition" not in plan_of(found)


def test_gates_of_all_tables_read_each_table_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(schemas, "UNIQUE_KEYS", {"p": [("a",), ("a", "b")], "c": [("x",)]})
    monkeypatch.setattr(schemas, "REQUIRED_COLUMNS", {"p": ["a", "b"], "c": ["x"]})
    monkeypatch.setattr(schemas, "REFERENCES", {"c": [("x", "p", "a"), ("y", "q", "z")]})
    spark.createDataFrame([(1, "u"), (1, "v"), (1, "v"), (2, None), (2, None), (None, ""), (None, "N")], "a int, b string").write.parquet(str(tmp_path / "p"))
    spark.createDataFrame([(1, 0), (7, 0), (7, 0), (None, 0)], "x long, y int").write.parquet(str(tmp_path / "c"))
    tables = {name: spark.read.parquet(str(tmp_path / name)) for name in "pc"}
    gates = quality.declared_gates(tables)
    assert values(gates, "check", "failures") == [
        ("c unique (x)", 1), ("c.x in p", 2), ("c.x not null", 1), ("p unique (a)", 3), ("p unique (a, b)", 2), ("p.a not null", 2), ("p.b not null", 2)]
    plan = gates._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and plan.count("Aggregate [check_no") == 2
    nothing = {name: df.where("false") for name, df in tables.items()}
    assert {row["failures"] for row in quality.declared_gates(nothing).collect()} == {0}
    assert quality.unique(tables["p"], ["a"], "p").first()["failures"] == 3 and quality.references(tables["c"], "x", tables["p"], "a", "r").first()["failures"] == 2
