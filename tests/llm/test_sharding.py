from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starhouse.llm import sharding as S
from starhouse.llm.registry import op8_sharding

SF_DIR = "/root/testdata/sf0.01"


def plain_permutation(number, n, seed=S.SEED):
    a, b = S._bases(n)

    def mix(digit, key, base):
        first = (digit % S._PRIME * 40_503 + key) % S._PRIME
        return (first * first + first * 48_271 + key) % S._PRIME % base

    while True:
        left, right = divmod(number, b)
        for k, key in enumerate(S._keys(seed)):
            if k % 2:
                right = (right + mix(left, key, b)) % b
            else:
                left = (left + mix(right, key, a)) % a
        number = left * b + right
        if number < n:
            return number


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4099])
def test_permutation_is_one_and_is_computable(spark, n):
    found = [x[0] for x in spark.range(n).select(S.permuted(F.col("id"), n)).collect()]
    assert sorted(found) == list(range(n))
    assert found == [plain_permutation(k, n) for k in range(n)]


def test_query_against_brute_force(spark):
    documents = sorted(tuple(x) for x in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    n = len(documents)
    expected = []
    for number, (doc_id, text) in enumerate(documents):
        slot, shard = divmod(plain_permutation(number, n), 8)
        raw = text.encode()
        expected.append((doc_id, len(raw) + 1, zlib.crc32(raw), "rows", shard, slot, None))
    rows = op8_sharding(spark, SF_DIR)
    assert sorted(tuple(x) for x in rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard").collect()) == expected


def test_odd_rows_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(S, "RANGE_ROWS", 10)
    rows = [(k, f"t{k}", 0, "x") for k in range(50)] + [(7, "t7", 0, "x")] * 30 + [(None, None, 0, "x"), (None, "", 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, number string")
    first = S.shard(docs, 4)
    assert first.columns == ["doc_id", "text", "number", "shard", "slot"]
    found = first.collect()
    places = Counter((x["shard"], x["slot"]) for x in found)
    assert len(found) == len(rows) and set(places.values()) == {1}
    per_shard = Counter(x["shard"] for x in found)
    assert max(per_shard.values()) - min(per_shard.values()) <= 1
    assert all({x["slot"] for x in found if x["shard"] == s} == set(range(n)) for s, n in per_shard.items())
    again = S.shard(docs.repartition(13), 4).collect()
    key = lambda x: (x["doc_id"], x["shard"], x["slot"])
    assert sorted(map(key, found), key=repr) == sorted(map(key, again), key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.shard(docs).count() == 0
