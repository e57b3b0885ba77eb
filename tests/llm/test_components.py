from __future__ import annotations

import random

from starhouse.llm.components import components


def test_components_of_chains_stars_and_odd_edges(spark):
    rng = random.Random(7)
    edges = [(k, k + 1) for k in range(0, 60)] + [(500, 501 + k) for k in range(300)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    edges += [(7, 7), (None, 3), (4, None), (500, 501), (501, 500), (2000, 2000)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    expected = sorted((x, find(x)) for x in root if find(x) != x)
    rng.shuffle(edges)
    found = components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    assert sorted((x["node"], x["least"]) for x in found.collect()) == expected


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
