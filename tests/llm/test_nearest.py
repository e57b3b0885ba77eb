from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from starhouse.llm import nearest as N
from starhouse.llm.registry import op10_nearest

SF_DIR = "/root/testdata/sf0.1"


def brute(rows, is_query, k=5):
    out = {}
    for i, v in rows:
        if is_query(i):
            scores = {}
            for j, w in rows:
                if j != i and len(w) == len(v):
                    scores[j] = max(scores.get(j, -2.0), float(np.dot(v, w) / np.sqrt(np.dot(v, v) * np.dot(w, w))))
            out[i] = sorted(((-round(s, 12), j) for j, s in scores.items()))[:k]
    return out


def test_query_recall_and_scores(spark):
    rows = [(x["vec_id"], np.array(x["embedding"], dtype=float)) for x in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    unit = {i: v / np.linalg.norm(v) for i, v in rows}
    matrix, ids = np.stack(list(unit.values())), np.array(list(unit))
    found = {}
    for x in op10_nearest(spark, SF_DIR).collect():
        found.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    queries = [i for i in unit if i % 50 == 0]
    assert sorted(found) == sorted(queries)
    hits = 0
    for q in queries:
        cosines = matrix @ unit[q]
        cosines[ids == q] = -2
        hits += len(set(ids[np.argsort(-cosines)[:5]]) & {x[1] for x in found[q]})
        ranks = sorted(found[q])
        assert [x[0] for x in ranks] == [1, 2, 3, 4, 5] and all(abs(x[2] - float(unit[q] @ unit[x[1]])) < 1e-12 for x in ranks)
        assert ranks == sorted(ranks, key=lambda x: (-x[2], x[1]))
    assert hits >= 0.9 * 5 * len(queries)


def test_index_finds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    code, queries = rng.integers(0, 256, (400, 4), dtype=np.uint8), rng.integers(0, 256, (20, 4), dtype=np.uint8)
    for radius, width in itertools.product((0, 3, 7, 9, 15, 32), (8, 16)):
        index = N.SubstringIndex(code, width)
        got = set(zip(*map(list, index.within(queries, radius)), strict=True))
        expected = {(q, k) for q in range(20) for k in range(400) if sum(bin(a ^ b).count("1") for a, b in zip(queries[q].tolist(), code[k].tolist(), strict=True)) <= radius}
        assert got == expected


def test_lookups_exclude_most_vectors_where_there_is_structure(spark):
    """The learned radius is small for clustered vectors: a fifth of the codes is reached at most, and nothing is lost."""
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((80, 32))
    vectors = centres[rng.integers(0, 80, 4000)] + 0.05 * rng.standard_normal((4000, 32))
    unit = N._unit(vectors)
    rotations = N.learn_rotations(unit)
    radius = N.learn_radius(unit, rotations, 5)
    code = N.codes(unit, rotations)
    index = N.SubstringIndex(code, N.substring_width(rotations.shape[1], radius))
    assert index.probed(code[::50], radius).mean() < 0.2
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    found = {}
    for x in N.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect():
        found.setdefault(x["query_id"], set()).add(x["vec_id"])
    cosines = unit[::50] @ unit.T
    cosines[np.arange(80), np.arange(0, 4000, 50)] = -2
    best = np.argsort(-cosines, axis=1)[:, :5]
    assert np.mean([len(found[50 * q] & set(own.tolist())) / 5 for q, own in enumerate(best)]) >= 0.95


@pytest.mark.parametrize("block, lengths", [(8192, 64), (16, 64), (16, 1)])
def test_odd_rows(spark, monkeypatch, block, lengths):
    """Small tables are searched whole: nulls, zeros, copies, repeated rows and ids, other lengths, extreme sizes."""
    monkeypatch.setattr(N, "INDEX_BLOCK", block)
    monkeypatch.setattr(N, "MAX_LENGTHS", lengths)
    rng = np.random.default_rng(9)
    rows = [(k, rng.standard_normal(8).tolist()) for k in range(40)] + [(k, [1.0] * 8) for k in range(100, 130)]
    rows += [(200, [1e200] * 7 + [2e200]), (201, [1e-200] * 8), (250, [3.0, 4.0]), (251, [4.0, 3.0]), (300, [1.0])]
    good = list(rows)
    rows += [(0, rows[0][1]), (100, [1.0] * 8)]
    rows += [(None, [1.0] * 8), (400, None), (401, []), (402, [0.0] * 8), (403, [1.0, None] * 4), (404, [float("nan")] * 8), (405, [float("inf")] + [1.0] * 7)]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, score string, rank int")
    found = {}
    for x in N.nearest(table, F.col("vec_id") % 10 == 0).collect():
        found.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    scaled = [(i, np.array(v) / np.abs(v).max()) for i, v in good]
    expected = brute(scaled, lambda i: i % 10 == 0)
    assert set(found) == {i for i, x in expected.items() if x}
    for i, nearest in found.items():
        assert [(j, round(s, 12)) for _, j, s in sorted(nearest)] == [(j, -s) for s, j in expected[i]], i


def test_empty_table(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert N.nearest(table, F.lit(True)).count() == 0
