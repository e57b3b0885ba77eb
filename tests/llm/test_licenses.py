from __future__ import annotations

import re

import pytest

from starhouse.llm import licenses as L


def words(text):
    return [x for x in re.split(r"[^\w]+|_", (text or "").lower()) if x]


def grams(found):
    return [tuple(found[k : k + 3]) for k in range(len(found) - 2)]


def brute(documents):
    """Every window of every document against every license."""
    out = {}
    for name, text in L.LICENSES:
        own = set(grams(words(text)))
        length = 4
        while length < len(words(text)):
            length *= 2
        for i, document in documents:
            found = grams(words(document))
            for start in range(0, max(1, len(found)), length):
                common = len(own & set(found[start : start + 2 * length - 2]))
                if 100 * common >= L.PERCENT * len(own):
                    out[i, name] = max(out.get((i, name), 0), common)
    return out


MIT = dict(L.LICENSES)["mit-grant"]


def test_passages_in_odd_documents(spark):
    filler = " ".join(f"filler{k}" for k in range(5000))
    cut = " ".join(x for k, x in enumerate(MIT.split()) if k % 33)
    documents = [
        (1, f"{filler} {MIT} {filler}"), (2, f"x {cut} y"), (3, "All rights reserved."), (3, "all RIGHTS — reserved"), (4, "all rights"), (5, None), (6, ""),
        (7, filler), (None, "Released under the MIT License."), (8, " ".join(MIT.split()[:20])), (9, "ALL rights\nreserved! " * 300),
        (10, "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0.")]
    docs = spark.createDataFrame([(*x, "k", 1) for x in documents], "doc_id long, text string, license string, own int")
    found = L.scan(docs).collect()
    expected = brute(documents)
    assert {(x["doc_id"], x["license"]): x["n_common"] for x in found} == expected and len(found) == len(expected)
    assert (2, "mit-grant") in expected and (8, "mit-grant") not in expected
    assert all(0.8 <= x["containment"] <= 1 for x in found)


@pytest.mark.parametrize("given", [(), (("short", "two words"),)])
def test_nothing_to_find(spark, given):
    docs = spark.createDataFrame([(1, "all rights reserved")], "doc_id long, text string")
    assert L.scan(docs, licenses=given).count() == 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert L.scan(docs).columns == ["doc_id", "license", "n_common", "containment"] and L.scan(docs).count() == 0
