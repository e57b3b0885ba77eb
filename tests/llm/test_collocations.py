from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from starhouse.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string"


def pieces(text):
    low = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
    return [re.findall(r"[^\x20\x09]+", x) for x in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def plain(rows, longest, least, inside, top):
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        for words in pieces(text):
            for size in range(1, longest + 1):
                counts[lang or "und" if lang is None else lang].update(tuple(words[k:k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for k, v in f.items() if len(k) == 1)
        found = {k: a for k, a in f.items() if len(k) > 1 and a >= least}
        rated = []
        for phrase, a in found.items():
            if any(100 * b >= inside * a and len(q) > len(phrase) and any(q[i:i + len(phrase)] == phrase for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase)))
            rated.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rated)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    words = ["a", "b", "New", "york", "É", "é", "日本", "x y", "#", "1", "don't"]
    out = []
    for k in range(160):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", " \t", ". ", ",", "\n", "\v", "!?"]) for _ in range(rng.randrange(0, 60)))
        out.append((k, text, rng.choice(["en", "de", None, ""])))
    passage = "the quick brown fox jumps over the lazy dog and runs on"
    out += [(1000 + k, passage + (" again" * (k % 3)), "en") for k in range(40)]
    return out + [(1, None, "en"), (2, "", "fr"), (3, " .,; \n", "fr"), (4, "z " * 30_000, "es"), (None, passage, "und"), (None, passage, "und")]


@pytest.mark.parametrize("longest, least, top", [(3, 10, 2000), (3, 2, 5), (2, 3, 2000), (4, 4, 2000)])
def test_phrases_equal_counting_every_occurrence(spark, rows, longest, least, top):
    found = C.collocations(spark.createDataFrame(rows, SCHEMA).repartition(4), longest=longest, least=least, top=top)
    assert sorted(map(tuple, found.collect())) == plain(rows, longest, least, 50, top)


@pytest.mark.parametrize("modulus", [1, 2, 5, 10**6])
def test_chunks_hold_each_occurrence_once(spark, rows, modulus):
    """Whatever the triggers: those at every window, or none at all."""
    docs = spark.createDataFrame(rows, SCHEMA)
    for longest in (2, 3, 4):
        got = Counter()
        for row in C.dictionary(docs, longest=longest, modulus=modulus).collect():
            words = row["chunk"].split(" ")
            own = len(words) - (0 if row["last"] else longest - 1)
            for size in range(1, longest + 1):
                for k in range(own):
                    if k + size <= len(words):
                        got[row["lang"], tuple(words[k:k + size])] += row["weight"]
        want = Counter()
        for _, text, lang in rows:
            for words in pieces(text):
                for size in range(1, longest + 1):
                    want.update(("und" if lang is None else lang, tuple(words[k:k + size])) for k in range(len(words) - size + 1))
        assert got == want


def test_equal_passages_share_chunks(spark):
    """Chunks depend on the words around them alone, so a passage gives the same ones at another place."""
    rng = random.Random(3)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(3000))
    rows = [(k, " ".join(f"q{rng.randrange(10**6)}" for _ in range(7 * k + 1)) + " " + passage, "en") for k in range(20)]
    chunks = C.dictionary(spark.createDataFrame(rows, SCHEMA))
    assert chunks.filter("weight = 20").count() > 0.9 * 3000 / C.MODULUS
    assert chunks.count() < 20 * 200


def test_counts_beyond_64_bit_products_are_exact(spark):
    big = 3_000_000_019
    counts = spark.createDataFrame([("en", "a b", big, 2), ("en", "a", 2 * big + 1, 1), ("en", "b", big + 5, 1)], "lang string, phrase string, f long, size int")
    assert C._scored(counts).first()["score"] == 1_000_000 * big * big // ((2 * big + 1) * (big + 5))


def test_empty_table_and_clashing_columns(spark):
    assert C.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([("one two", "en", 1, "x", 2)] * 10, "text string, lang string, chunk int, phrase string, `a.b` int")
    assert [tuple(x) for x in C.collocations(docs).collect()] == [("en", 1, "one two", 10, 10, 10, 20, 1_000_000)]
