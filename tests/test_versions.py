"""Sets of tables and the switch between them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from conftest import values
from test_refresh import sources  # noqa: F401  (the landed files of the refresh tests)

from starhouse import schemas
from starhouse.operators import linking
from starhouse.plans import artworks, refresh
from starhouse.sources import tables, versions

MINIMUMS = {"bridge_artwork_artist": 1}


def test_one_file_switches_a_whole_set(spark, tmp_path):
    root = str(tmp_path / "root")
    assert versions.current(spark, root) == root  # nothing published: the folder itself
    folders = [versions.new_set(root) for _ in range(4)]
    for n, folder in enumerate(folders):
        spark.range(n + 1).selectExpr("id as batch_no").write.parquet(tables.table_path(folder, "staging_requests"))
        if n != 2:  # one refresh never gets so far
            versions.publish(spark, folder)
            assert versions.current(spark, f"{root}/") == folder and tables.read_table(spark, root, "staging_requests").count() == n + 1
    assert versions.clean(spark, root, keep=2) == [folders[0].rsplit("/", 1)[1]]
    assert tables.read_table(spark, folders[1], "staging_requests").count() == 2  # of the set before, still readable
    assert versions.clean(spark, root, keep=1, abandoned_hours=0) == sorted(x.rsplit("/", 1)[1] for x in folders[1:3])
    assert versions.current(spark, root) == folders[3]


def test_refreshes_published_at_the_same_time_leave_one_whole_set(spark, tmp_path):
    root = str(tmp_path)
    folders = [versions.new_set(root) for _ in range(8)]
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda x: versions.publish(spark, x), folders))
    assert len(set(folders)) == 8 and versions.current(spark, root) in folders


def stamps(spark, root):
    folder = versions.current(spark, root)
    found = set()
    for table, columns in schemas.TABLES.items():
        for stamp in set(schemas.LOAD_STAMPS) & set(columns):
            found |= {row[0] for row in tables.read_table(spark, folder, table).select(stamp).distinct().collect()}
    return found


def test_a_refresh_that_stops_between_two_tables_changes_nothing(spark, sources, tmp_path, monkeypatch):  # noqa: F811
    root = str(tmp_path / "w")
    refresh.run_refresh(spark, sources, root, date(2024, 1, 1), MINIMUMS)
    before, seen = versions.current(spark, root), stamps(spark, root)
    assert len(seen) == 1  # one clock per refresh
    write = refresh.write_table

    def stops(df, folder, table, at):
        if table == "fact_artist_summary":
            raise OSError("the machine is gone")
        return write(df, folder, table, at)

    monkeypatch.setattr(refresh, "write_table", stops)
    with pytest.raises(OSError, match="gone"):
        refresh.run_refresh(spark, sources, root, date(2024, 1, 1), MINIMUMS)
    assert versions.current(spark, root) == before and stamps(spark, root) == seen
    monkeypatch.undo()
    with ThreadPoolExecutor(2) as pool:
        runs = [pool.submit(refresh.run_refresh, spark, sources, root, date(2024, 1, 1), MINIMUMS) for _ in range(2)]
        assert runs[0].result() == runs[1].result()
    assert versions.current(spark, root) != before and len(stamps(spark, root)) == 1


def test_one_pass_parts_accepted_rows_from_rejected_values(spark, tmp_path):
    staging = spark.createDataFrame(
        [("1", "a", "12", "x1", "1999-01-01"), ("two", "b", "n/a", None, "never"), ("3", "c", "1e9", "2", None), (None, "d", "n/a", "?", "?")],
        "object_id string, title string, height_cm string, width_cm string, date_acquired string")
    for name in set(artworks.STAGING_COLUMNS) - set(staging.columns):
        staging = staging.selectExpr("*", f"cast(null as string) as {name}")
    staging.write.parquet(str(tmp_path / "staging"))
    landed = spark.read.parquet(str(tmp_path / "staging"))
    plan = tables._split(artworks.tagged_artworks(landed), "transformed_artworks")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "hashpartitioning" not in plan
    written = tables.write_table(artworks.tagged_artworks(landed), str(tmp_path / "w"), "transformed_artworks")
    assert written.rows == 2 and written.rejected == {"height_cm": 1}
    accepted = tables.read_table(spark, str(tmp_path / "w"), "transformed_artworks")
    assert dict(accepted.dtypes) == schemas.TABLES["transformed_artworks"]
    assert values(accepted, "artwork_id", "title") == [(1, "a"), (3, "c")]
    assert values(tables.read_rejected(spark, str(tmp_path / "w"), "transformed_artworks"), "table_name", "row_key", "column_name", "raw_value", "reason") == [
        ("transformed_artworks", "1", "width_cm", "x1", "no number"), ("transformed_artworks", "3", "height_cm", "1.0E9", "does not fit"),
        ("transformed_artworks", "two", "date_acquired", "never", "no date"), ("transformed_artworks", "two", "height_cm", "n/a", "no number"),
        ("transformed_artworks", "two", "object_id", "two", "bad key"),
    ]


def test_nothing_rejected_and_nothing_accepted_are_empty_tables(spark, tmp_path):
    people = spark.createDataFrame([(1,)], "artist_id int")
    for name, ids in (("good", "1"), ("bad", "x"), ("none", "")):
        works = spark.createDataFrame([("7", ids)], "object_id string, constituent_id string")
        tables.write_table(linking.tagged_bridge(works, people), str(tmp_path / name), "bridge_artwork_artist")
    read = {name: (tables.read_table(spark, str(tmp_path / name), "bridge_artwork_artist").count(),
                   tables.read_rejected(spark, str(tmp_path / name), "bridge_artwork_artist").count()) for name in ("good", "bad", "none")}
    assert read == {"good": (1, 0), "bad": (0, 1), "none": (0, 0)}


def test_tagged_bridge_equals_the_plain_one(spark):
    works = spark.createDataFrame(
        [("1", "1, 2, 1"), ("2", "x,2,x, 9"), ("3", None), ("4", ""), ("bad", "1"), ("5", "9"), ("6", "2,3000000000")], "object_id string, constituent_id string")
    people = spark.createDataFrame([(1,), (2,)], "artist_id int")
    tagged = linking.tagged_bridge(works, people)
    assert values(tagged.where("_accepted"), "artwork_id", "artist_id", "artists_total") == values(
        linking.build_bridge(works, people), "artwork_id", "artist_id", "artists_total")
    found = values(tagged.selectExpr("_row_key", "explode(_rejected) as r"), "_row_key", "r.raw_value", "r.reason")
    assert found == [("2", " 9", "unknown artist"), ("2", "x", "bad list id"), ("5", "9", "unknown artist"), ("6", "3000000000", "bad list id")] or found == [
        ("2", "9", "unknown artist"), ("2", "x", "bad list id"), ("5", "9", "unknown artist"), ("6", "3000000000", "bad list id")]
