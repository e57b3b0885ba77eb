from __future__ import annotations

from collections import Counter

import pytest
from test_decontamination import brute as contamination
from test_mixing import plain_targets
from test_near_dedup import brute as components

import corpus_pipeline as C
from starhouse.llm import decontamination
from starhouse.llm.common import stored

SF_DIR = "/root/testdata/sf0.001"


FOREIGN = {
    9004: "Привет мир, как дела сегодня, мы идем домой и читаем книгу", 9005: "日本語のテキストです。今日は天気がいいですね。",
    9006: "Hyvää päivää maailma mitä kuuluu tänään olemme menossa kotiin lukemaan kirjaa ja syömään hyvää ruokaa",
    9007: "Καλημέρα κόσμε, τι κάνεις σήμερα, πάμε σπίτι να διαβάσουμε ένα βιβλίο", 9008: "zxqj vkkp wqzx jjqk pvvx qqzk xjwv kkqz wxpj vqqz",
}
CLEAN = {9011: "the house is red", 9012: "en la casa de la que los", 9013: "the and of that is in to " * 30, 9014: "der und die das ist nicht in den " * 9}


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = spark.createDataFrame([(9001, "1234 !?", "en", "src1", 7), (9002, None, "en", None, None), (9003, "", None, "src1", 0)], docs.schema)
    planted = spark.createDataFrame([(i, text, None, "src1", len(text)) for i, text in (FOREIGN | CLEAN).items()], docs.schema)
    found = {"documents": docs.union(extra).union(planted)}
    docs = found["documents"]
    for name, stage in C.STAGES:
        docs = found[name] = stored(stage(spark, docs, SF_DIR), name)
    return {name: df.collect() for name, df in found.items()}


def tables_schema(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").schema


def rows(table):
    return sorted((tuple(x[c] for c in C.COLUMNS) for x in table), key=repr)


def test_language_stage_keeps_learned_languages(tables):
    """Unlearned scripts and languages, noise, and texts without letters go; short clean texts stay, and hardly a document is lost."""
    kept, ids = rows(tables["language_id"]), {x["doc_id"] for x in tables["language_id"]}
    assert set(kept) <= set(rows(tables["documents"])) and len(kept) == len(ids)
    assert not ids & ({9001, 9002, 9003} | set(FOREIGN)) and set(CLEAN) <= ids
    lost = [x for x in tables["documents"] if x["doc_id"] < 9001 and x["doc_id"] not in ids]
    assert len(lost) <= 2 and all(sum(map(str.isalpha, x["text"])) < 16 for x in lost)


def test_near_duplicate_stage_keeps_one_of_each_group(tables):
    before = tables["language_id"]
    kept = {x[0] for x in components([(x["doc_id"], x["text"]) for x in before], 80) if x[3]}
    assert 0 < len(kept) < len(before)
    assert rows(tables["near_dedup"]) == rows(x for x in before if x["doc_id"] in kept)


def test_decontamination_stage_drops_and_cuts(spark, tables):
    items = [tuple(x) for x in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    before = {x["doc_id"]: x for x in tables["near_dedup"]}
    found = {x[0]: x for x in contamination([(i, x["text"]) for i, x in before.items()], items)}
    after = {x["doc_id"]: x for x in tables["decontamination"]}
    assert set(after) == {i for i, x in found.items() if not x[5]} and len(after) < len(before)
    for i, x in after.items():
        if found[i][2]:
            assert len(decontamination.words(x["text"])) == found[i][1] - found[i][2] and x["n_chars"] == len(x["text"])
        else:
            assert x == before[i]


def test_mixing_stage_repeats_documents(tables):
    before = {x["doc_id"]: x for x in tables["decontamination"]}
    size = {i: len(x["text"].split()) for i, x in before.items()}
    sums, taken = Counter(), Counter()
    for i, x in before.items():
        sums[x["source"]] += size[i]
    copies = Counter(x["doc_id"] for x in tables["mixing"])
    assert set(rows(tables["mixing"])) <= set(rows(before.values())) and max(copies.values()) <= 2
    for i, n in copies.items():
        taken[before[i]["source"]] += n * size[i]
    targets = plain_targets(sums)
    assert all(abs(taken[s] - targets[s]) <= max(size[i] for i in size if before[i]["source"] == s) for s in targets)


def test_sharding_stage_places_every_row(tables):
    last = tables["sharding"]
    assert rows(last) == rows(tables["mixing"])
    assert len({(x["shard"], x["slot"]) for x in last}) == len(last)
    counts = Counter(x["shard"] for x in last)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert all({x["slot"] for x in last if x["shard"] == s} == set(range(n)) for s, n in counts.items())


def test_run_applies_the_stages(spark, tables, tmp_path):
    assert len(C.STAGES) == 5 and C.ORACLE_SQL is None
    spark.createDataFrame(tables["documents"], tables_schema(spark)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = C.run(spark, str(tmp_path))
    assert sorted(x["doc_id"] for x in docs.collect()) == sorted(x["doc_id"] for x in tables["sharding"])


def test_stages_take_empty_and_odd_tables(spark):
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    odd = [(None, "some words here", "en", None, None), (1, "some words here", None, "s", 3), (1, "some words here", None, "s", 3), (2, None, None, None, None)]
    for given in ([], odd):
        docs = spark.createDataFrame(given, schema)
        for name, stage in C.STAGES:
            out = stage(spark, docs, SF_DIR)
            assert out.columns[:5] == C.COLUMNS and out.count() <= 2 * len(given), name
