from __future__ import annotations

import random
import re

import numpy as np
import pytest

from starhouse.llm import near_dedup as N
from starhouse.llm.registry import op9_near_dedup

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(documents, percent=85):
    """Every document against every other."""
    rows = [(i, shingles(text)) for i, text in documents]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    out = [(i, len(a), find(i), find(i) == i) if i is not None else (None, len(a), None, True) for i, a in rows]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(x) for x in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_query_against_brute_force(spark):
    documents = [tuple(x) for x in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute(documents)
    assert any(not x[3] for x in expected)
    assert rows_of(op9_near_dedup(spark, SF_DIR)) == expected


def test_signatures_follow_the_plain_algorithm():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 2, 30, 200)]
    got = N.signatures(sets)
    for each, found in zip(sets, got, strict=True):
        expected = [2**64 - 1] * N.PLACES
        for element in each.tolist():
            order = list(range(N.PLACES))
            for step in range(N.PLACES):
                draw = int(N.mixed(np.array([(element + (step + 1) * N._GOLDEN) % 2**64], dtype=np.uint64))[0])
                to = step + ((draw >> 32) * (N.PLACES - step) >> 32)
                order[step], order[to] = order[to], order[step]
                expected[order[step]] = min(expected[order[step]], draw & 0xFFFFFFFF | step << 32)
        assert found.tolist() == expected


def test_sets_in_parts_give_the_same_signature(monkeypatch):
    sets = [np.arange(1, 900, dtype=np.uint64) * np.uint64(2**40 + 7), np.array([], dtype=np.uint64), np.array([5], dtype=np.uint64)]
    whole = N.signatures(sets)
    monkeypatch.setattr(N, "_WALKED", 100)
    assert (N.signatures(sets) == whole).all()


@pytest.mark.parametrize("block", [200_000, 400])
def test_families_and_odd_rows(spark, monkeypatch, block):
    """A family around the threshold, with clusters cut into blocks; ties, repeated rows, nulls and long texts."""
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "LEAST_BLOCK", block)
    monkeypatch.setattr(N, "SMALL", 20)
    rng = random.Random(6)
    base = [f"word{rng.randrange(900)}" for _ in range(150)]
    documents = []
    for k in range(70):
        words = list(base)
        for _ in range(rng.randrange(5)):
            words[rng.randrange(150)] = f"new{rng.randrange(10_000)}"
        documents.append((100 + k, " ".join(words)))
    long = " ".join(f"l{rng.randrange(50_000)}" for _ in range(40_000))
    documents += [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One\ttwo "), (5, "one two"), (6, "one two three"), (7, long), (8, long + " end"),
        (None, "one two"), (None, None), (9, "É é a b c"), (10, "é É a b c"), (300, documents[0][1].upper()), (301, documents[0][1]),
        (11, "p q r s t u"), (11, "v w x y z"), (12, "v w x y z"), (-4, "V w x y z")]
    rng.shuffle(documents)
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in documents], "doc_id long, text string, kept int, component_id string")
    assert rows_of(N.near_duplicates(docs)) == brute(documents)
    left = N.distinct_documents(docs)
    assert left.columns == docs.columns
    kept = sorted({x[0] for x in brute(documents) if x[3] and x[0] is not None})
    assert sorted(x["doc_id"] for x in left.collect() if x["doc_id"] is not None) == kept
    assert left.filter("doc_id is null").count() == 2


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert N.near_duplicates(docs).count() == 0 and N.distinct_documents(docs).count() == 0


def test_each_text_of_an_id_stays_once_by_a_fixed_order(spark):
    """Repeated rows stay once, different texts of one id all stay, and what comes with them does not depend on partitions."""
    rows = [(1, "one two three four five six", "b", 2), (1, "one two three four five six", "a", 9), (1, "seven eight nine", "z", 1),
            (1, None, "y", 0), (1, None, "x", 5), (2, "one two three four five six", "a", 1), (None, "q", "n", 1), (None, "q", "n", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, one int")
    expected = sorted([rows[1], rows[2], rows[4], rows[6], rows[7]], key=repr)
    for n in (1, 3, 7):
        found = N.distinct_documents(docs.repartition(n, "one"), percent=80)
        assert found.columns == docs.columns and sorted(map(tuple, found.collect()), key=repr) == expected


def test_bands_find_pairs_at_their_threshold():
    for percent in (60, 70, 80, 85, 90, 95):
        rows = N.rows_of_band(percent)
        assert (1 - (percent / 100) ** rows) ** (N.PLACES // rows) < 4e-4
    assert N.rows_of_band(85) == 8 and N.rows_of_band(80) == 7


def test_a_tight_family_is_settled_by_its_first_document(spark):
    """Copies with a changed word are all linked with the first; only what it does not reach is compared any further."""
    base = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join([*base[:k], f"x{k}", *base[k + 1:]])) for k in range(200)]
    chain = [(500 + k, " ".join(f"w{j}" for j in range(5 * k, 5 * k + 280))) for k in range(8)]  # each like the next, the last unlike the first
    texts = spark.createDataFrame(rows + chain, "doc_id long, text string")
    members = texts.selectExpr("0L as cluster", "doc_id", "296L as n_shingles")
    near = N._attached(members, texts, 85)
    assert near.filter("node < 500").count() == 199
    assert {x["least"] for x in near.collect()} == {0} and near.filter("node >= 500").count() < 8
    assert rows_of(N.near_duplicates(texts)) == brute(rows + chain)
