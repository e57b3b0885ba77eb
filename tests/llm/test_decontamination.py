from __future__ import annotations

import hashlib
import random
import re

import pytest

from starhouse.llm import decontamination as D
from starhouse.llm.registry import op4_decontamination

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text)) if text else []


def brute(documents, items, window=13):
    """Every window of every item, looked up at every place."""
    windows = {}
    for item, text in items:
        found = plain_words(text)
        if item is None or not found:
            continue
        size = min(window, len(found))
        for k in range(len(found) - size + 1):
            windows.setdefault(tuple(found[k : k + size]), set()).add(str(item))
    sizes = {len(x) for x in windows}
    out = []
    for doc_id, text in documents:
        found, hit, owners = plain_words(text), set(), set()
        for size in sizes:
            for k in range(len(found) - size + 1):
                if (part := tuple(found[k : k + size])) in windows:
                    hit.update(range(k, k + size))
                    owners |= windows[part]
        digest = hashlib.sha256(",".join(sorted(owners)).encode()).hexdigest()
        out.append((doc_id, len(found), len(hit), len(owners), digest, bool(hit) and 20 * len(hit) >= len(found)))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(x) for x in df.collect()), key=repr)


def test_query_against_brute_force(spark):
    documents = [tuple(x) for x in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(x) for x in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    expected = brute(documents, items)
    assert any(x[-1] for x in expected)
    assert rows(op4_decontamination(spark, SF_DIR)) == expected


@pytest.mark.parametrize("piece, block", [(2000, 200_000), (3, 40)])
def test_automaton_against_brute_force(spark, monkeypatch, piece, block):
    """Few different words, so that sequences repeat; also with many pieces and automata."""
    monkeypatch.setattr(D, "PIECE", piece)
    monkeypatch.setattr(D, "BLOCK", block)
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice("a b c É1".split()) for _ in range(n))
    items = [(k, say(rng.choice([0, 1, 3, 4, 5, 9, 30]))) for k in range(2, 20)] + [(2, "a b"), (None, "a b c"), (50, None), (51, "..")]
    documents = [(k, say(rng.randrange(60))) for k in range(60)] + [(None, say(30)), (7, None), (8, ""), (8, ""), (9, "--"), (10, say(5000))]
    docs = spark.createDataFrame([(*x, "mine") for x in documents], "doc_id long, text string, found string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = D.find(docs, bench, window=4).select(
        "doc_id", "found.n_words", "found.n_hit", "found.items", D.items_digest(), D.contaminated())
    got = sorted(((x[0], x[1], x[2], len(x[3]), *x[4:]) for x in map(tuple, found.collect())), key=repr)
    assert got == brute(documents, items, 4)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert D.find(docs, bench).count() == 0
    one = spark.createDataFrame([(1, "a b")], docs.schema)
    assert D.find(one, bench).select("found.n_words", "found.n_hit").first() == (2, 0)
    assert D.clean(docs, bench).columns == ["doc_id", "text"]


@pytest.mark.parametrize("block", [200_000, 6])
def test_clean_cuts_spans_and_drops_covered_documents(spark, monkeypatch, block):
    """With one automaton, and with several in a pass each."""
    monkeypatch.setattr(D, "BLOCK", block)
    item = " ".join(f"w{k}" for k in range(15))
    long = " ".join(f"x{k}" for k in range(400))
    docs = spark.createDataFrame(
        [(1, f"Ä, {long} ({item.upper()}) end.", "k", None), (2, f"so {item}", "k", "f"), (3, None, None, "f"), (4, "as it is\n", "k", "f")],
        "doc_id long, text string, row string, found string",
    )
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = {x["doc_id"]: x for x in D.clean(docs, bench).collect()}
    assert set(kept) == {1, 3, 4}
    assert kept[1]["text"] == f"Ä, {long} () end." and kept[1]["row"] == "k"
    assert kept[3]["text"] is None and kept[4]["text"] == "as it is\n"
