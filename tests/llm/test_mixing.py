from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starhouse.llm import mixing as M
from starhouse.llm.registry import op7_mixing

SF_DIR = "/root/testdata/sf0.01"


def plain_targets(sizes, share=1.5, cap=2.0):
    """Shares by weight; what is above the cap stops there and the rest is shared again."""
    names = sorted(sizes, key=lambda x: (x is None, (x or "").encode("utf-32-be")))
    weight = {x: (5, 2, 1)[k % 3] for k, x in enumerate(names)}
    left, open_ones, target = share * sum(sizes.values()), set(names), {}
    while open_ones:
        level = left / sum(weight[x] for x in open_ones)
        over = [x for x in open_ones if weight[x] * level > cap * sizes[x]]
        if not over:
            return target | {x: weight[x] * level for x in open_ones}
        for x in over:
            target[x] = cap * sizes[x]
            left -= target[x]
            open_ones.remove(x)
    return target


def checked(rows, documents):
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, text, _ in documents}
    source = {i: s for i, _, s in documents}
    sums, taken = Counter(), Counter()
    for i in size:
        sums[source[i]] += size[i]
    targets = plain_targets(sums)
    for x in rows:
        s = source[x["doc_id"]]
        assert (x["size"], x["source_size"]) == (size[x["doc_id"]], sums[s]) and abs(x["target"] - targets[s]) < 1e-6 * (1 + targets[s])
        assert x["taken"] <= 2 * x["size"] and (x["size"] == 0 or x["taken"] % x["size"] == 0)
        taken[s] += x["taken"]
    return targets, taken


def test_query_meets_targets(spark):
    documents = [tuple(x) for x in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source").collect()]
    rows = op7_mixing(spark, SF_DIR).collect()
    assert len(rows) == len(documents)
    targets, taken = checked(rows, documents)
    assert all(abs(taken[s] - targets[s]) <= 50 for s in targets)
    again = op7_mixing(spark, SF_DIR).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_hot_cells_odd_rows_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(M, "CELL", 7)
    documents = [(k, "one two three", "a" if k % 3 else None) for k in range(90)] + [(k, "w " * (k % 40), "b") for k in range(90, 200)]
    documents += [(200, None, "b"), (201, "", "c"), (202, "x " * 3000, "d"), (203, "y", "é")]
    docs = spark.createDataFrame([(*x, "s", 1.5) for x in documents], "doc_id long, text string, source string, size string, copies double")
    targets = M.capped_targets(M.cyclic_weights(M.sizes(docs)))
    mixed = M.mix(docs, targets)
    assert set(mixed.columns) == {"doc_id", "text", "source", "size", "copies", "taken"}
    rows = mixed.alias("m").join(targets.alias("t"), F.col("m.source").eqNullSafe(F.col("t.source"))).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert len(rows) == len(documents)
    wanted, taken = checked(rows, documents)
    assert abs(taken[None] - wanted[None]) <= 3 and abs(taken["a"] - wanted["a"]) <= 3 and abs(taken["b"] - wanted["b"]) <= 40
    copies = M.repeated(mixed, ["doc_id", "text"]).count()
    assert copies == mixed.agg(F.sum("copies")).first()[0]


def test_base_rates_tilt_and_cap(spark):
    rows = [(k, "a b c d e", "s", 1.0 if k % 2 else 3.0) for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, quality double")
    targets = spark.createDataFrame([("s", 30_000.0)], "source string, target double")
    mixed = M.mix(docs, targets, base=F.col("quality")).groupBy("quality").agg(F.sum("taken").alias("n")).collect()
    taken = {x["quality"]: x["n"] for x in mixed}
    # Rates 2 (the cap) and 1: 2 * 10,000 + 1 * 10,000 words; 3 : 1 without the cap.
    assert abs(taken[3.0] - 20_000) <= 5 and abs(taken[1.0] - 10_000) <= 5


def test_repeated_rows_share_their_fate(spark):
    docs = spark.createDataFrame([(k % 5, "a b", "s") for k in range(50)] + [(None, "a b", "s")] * 3, "doc_id long, text string, source string")
    mixed = M.mix(docs, M.capped_targets(M.cyclic_weights(M.sizes(docs))))
    found = defaultdict(set)
    for x in mixed.collect():
        found[x["doc_id"]].add(x["copies"])
    assert mixed.count() == 53 and all(len(x) == 1 for x in found.values())


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "s")]])
def test_nothing_to_take(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = M.mix(docs, M.capped_targets(M.cyclic_weights(M.sizes(docs)))).collect()
    assert [x["taken"] for x in mixed] == [0] * len(rows)


def test_copies_keep_columns_of_clashing_names(spark):
    docs = spark.createDataFrame([(1, "mine", 2, 0.5), (2, "yours", 0, None), (3, None, 1, 1.5)], "doc_id long, copy string, copies int, `a.b` double")
    names = ["doc_id", "copy", "a.b"]
    assert sorted(map(tuple, M.repeated(docs, names).collect()), key=repr) == [(1, "mine", 0.5), (1, "mine", 0.5), (3, None, 1.5)]
