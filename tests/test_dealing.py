from __future__ import annotations

from conftest import SF_DIR, values
from pyspark.sql import functions as F
from starhouse.operators import dealing, quality
from verification.warehouse import Warehouse


def test_partitions_follow_rows_beyond_one_a_core(spark):
    cores = spark.sparkContext.defaultParallelism
    assert dealing.tasks_for(spark, 0) is None and dealing.tasks_for(spark, cores * dealing.TASK_ROWS) is None
    assert dealing.tasks_for(spark, cores * dealing.TASK_ROWS + 1) == cores + 1
    assert dealing.tasks_for(spark, 100 * cores * dealing.TASK_ROWS) == 100 * cores


def test_works_meet_links_in_tasks_of_bounded_rows(spark, monkeypatch):
    plain = Warehouse(spark, SF_DIR)
    assert plain.link_tasks is None
    monkeypatch.setattr(dealing, "TASK_ROWS", 100)
    many = Warehouse(spark, SF_DIR)
    assert many.link_tasks == many.table("lineitem").count() // 100

    def largest(df):
        return df.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0]

    assert largest(many.dated_bridge) < 500 < largest(plain.dated_bridge)
    assert largest(many.acquisitions) < 500 < largest(plain.acquisitions)
    for name in ("dated_bridge", "acquisitions", "artist_summary", "transformed_geography"):
        one, two = (getattr(w, name).drop("created_at") for w in (plain, many))
        assert values(one, *one.columns) == values(two, *two.columns)
    for w in (plain, many):
        twice = w.bridge.unionByName(w.bridge.where("artist_id = 1"))
        repeated = w.bridge.where("artist_id = 1").count()
        assert quality.unique(twice, ["artwork_id", "artist_id"], "bridge", w.link_tasks).first()["failures"] == repeated > 0


def test_tables_of_a_written_bridge_join_no_links_again(spark):
    plain = Warehouse(spark, SF_DIR)
    written = plain.on_written_bridge()
    for name in ("acquisitions", "transformed_artists", "transformed_geography"):
        one, two = (getattr(w, name) for w in (plain, written))
        read = [[x for x in df.inputFiles() if "lineitem" in x] for df in (one, two)]
        assert read[0] and not read[1]
        kept = [x for x in one.columns if x not in ("created_at", "transformed_at")]
        assert values(one, *kept) == values(two, *kept)
