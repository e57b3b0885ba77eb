from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starhouse.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"


def every_50th():
    return F.col("vec_id") % 50 == 0


def plain(rows, k=5, n=3):
    """All pairs, by the rule, in whole numbers."""
    rows = [
        (i, [math.floor(256 * x) for x in v], y) for i, v, y in rows
        if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(256 * x) for x in v)]
    out = []
    for at, (i, v, y) in enumerate(rows):
        if i % 50 == 0:
            scored = [
                (-max(-2**63 + 1, min(2**63 - 1, sum(map(int.__mul__, v, w)))), j, z)
                for k2, (j, w, z) in enumerate(rows) if k2 != at and len(w) == len(v)]
            for p, j, _ in sorted(x for x in scored if x[2] == y)[:k]:
                fits = sorted((s, o) for s, o, z in scored if z != y and -50 * p <= -100 * s <= -95 * p)
                out += [(i, j, r, o, -p, -s) for r, (s, o) in enumerate(fits[:n], 1)]
    return sorted(out)


def vectors(rng, n, length, centres=None, start=0):
    points = rng.standard_normal((n, length)) if centres is None else centres[rng.integers(0, len(centres), n)] + 0.02 * rng.standard_normal((n, length))
    return [(start + k, row.tolist(), int(rng.integers(0, 3))) for k, row in enumerate(points)]


def test_mining_equals_all_pairs_on_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = vectors(rng, 700, 6) + vectors(rng, 90, 3, start=1000) + vectors(rng, 8, 1, start=2000)
    rows += [(3000 + k, [0.5, 1.0, -0.25, 0.0, 0.0, 2.0], k % 2) for k in range(120)]  # one vector very often: ties
    rows += [(50, [1.0] * 6, 1), (50, [1.0] * 6, 1), (51, [1.0] * 6, 1)]  # repeated anchors
    rows += [(None, [1.0] * 6, 1), (100, None, 1), (150, [1.0] * 6, None), (4000, [None] * 6, 1), (4050, [math.nan] * 6, 1), (4100, [math.inf] * 6, 2),
             (4150, [1e307] * 6, 1), (4200, [], 1), (4201, [], 1), (4202, [], 2), (4250, [1e18] * 2, 1), (4251, [1e3, 2e3], 1), (4252, [3e14, -7.0], 2),
             (4253, [1e15] * 2, 1), (4300, [-1.0] * 6, 2), (-50, [0.3] * 6, 0)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as block", "2 as ids", "3 as `a.b`")
    for block in (16, 1024):
        assert sorted(map(tuple, H.mine(table, every_50th(), block=block).collect())) == plain(rows)


def test_fewer_rows_than_asked_for_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.7, 0.0], 2)]
    assert [tuple(x) for x in H.mine(spark.createDataFrame(rows, SCHEMA), every_50th()).collect()] == [(0, 1, 1, 2, 58880, 45824)] == plain(rows)
    assert H.mine(spark.createDataFrame(rows[:1], SCHEMA), every_50th()).count() == 0
    assert H.mine(spark.createDataFrame([], SCHEMA), every_50th()).count() == 0


def test_zone_maps_leave_most_blocks_of_clustered_vectors_unread(spark):
    """Blocks along the curve are tight where vectors have structure, so bounds exclude most of them."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((40, 16))
    rows = vectors(rng, 6000, 16, centres)
    held = H.blocks(spark.createDataFrame(rows, SCHEMA).repartition(3), every_50th(), "vec_id", "label", "embedding", 50)
    groups = H._groups(held)
    whole = groups.select("*", F.transform("numbers", lambda _: F.lit(H._ENDS[0])).alias("start"), F.transform("numbers", lambda _: F.lit(H._ENDS[1])).alias("end"))
    n_blocks, n_groups = held.count(), groups.count()
    best = H._best(H._read(whole.select("group", F.col("group").alias("block")), whole, held, 5, True, 1), 5)
    read = H._choose(H._limited(whole, best, 5), held.select("block", "low", "high")).count()
    assert read < 0.2 * n_blocks * n_groups
    assert sorted(map(tuple, H.mine(spark.createDataFrame(rows, SCHEMA), every_50th(), block=50).collect())) == plain(rows)


@pytest.mark.parametrize("dimensions, bits", [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_touch(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    places = H.hilbert(cells, bits)
    assert sorted(places.tolist()) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_bounds_hold_for_every_vector_of_a_block():
    rng = np.random.default_rng(1)
    for scale in (1.0, 256.0, 2.0**40):
        block, asked = np.floor(scale * rng.standard_normal((60, 9))), np.floor(scale * rng.standard_normal((20, 9)))
        least, most = H.bounds(asked, block.min(axis=0)[None], block.max(axis=0)[None])
        exact = H.scores(asked, block)
        assert (least <= exact).all() and (exact <= most).all()
