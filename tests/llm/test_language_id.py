from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from starhouse.llm import language_id as L
from starhouse.llm.registry import op3_language_id

SF_DIR = "/root/testdata/sf0.01"


def plain_bundle(text):
    """One trigram after the other."""
    letters = "".join(x if x.isalpha() else " " for x in f" {text.lower()} ")
    runs = " ".join(letters.split())
    runs = f" {runs} " if runs else ""
    total = np.zeros(L.DIMENSIONS)
    for a, b, c in zip(runs, runs[1:], runs[2:], strict=False):
        total += np.roll(L._letter_vector(ord(a)), 2) * np.roll(L._letter_vector(ord(b)), 1) * L._letter_vector(ord(c)).astype(float)
    return total


def test_query_learns_languages(spark):
    labels = {x["doc_id"]: x["lang"] for x in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op3_language_id(spark, SF_DIR).collect()
    assert sorted(x["doc_id"] for x in rows) == sorted(labels)
    assert all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2) and 0 <= x["score"] <= 1 for x in rows)
    held = [x for x in rows if x["held_out"]]
    assert np.mean([x["lang_pred"] == labels[x["doc_id"]] for x in held]) > 0.99


def test_predictions_equal_plain_cosines(spark):
    """Every text against every profile, all made one trigram after the other; ties go to the first language."""
    rng = random.Random(5)
    rows = [(k, " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(9))), lang)
            for k in range(60) for letters, lang in [rng.choice([("abcd", "x"), ("cdéf", "y"), ("語の文", "z"), ("abcd", None)])]]
    rows += [(100, "abc abd", "t2"), (101, "abc abd", "t1"), (102, "abc", None), (103, "1 2", "x"), (104, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = {}
    for _, text, lang in rows:
        if lang and text is not None:
            profiles[lang] = profiles.get(lang, 0) + plain_bundle(text)
    found = {x["doc_id"]: x for x in L.predict(docs, L.train(docs)).collect()}
    for k, text, _ in rows:
        own = plain_bundle(text or "")
        cosines = {lang: round(max(0.0, float(own @ p / np.linalg.norm(own) / np.linalg.norm(p))), 9) for lang, p in sorted(profiles.items())} if own.any() else {}
        best = max(cosines, key=cosines.get) if cosines else "und"
        assert found[k]["lang_pred"] == best and abs(found[k]["score"] - cosines.get(best, 0.0)) < 1e-8
    assert found[102]["lang_pred"] == "t1"


def test_bundles_are_sums_of_trigrams(monkeypatch):
    texts = ["Ab, c!", "", "12", "été ÉTÉ", "語の文字 mix", "a" * 50 + " bc" * 90]
    for chunk in (1 << 20, 40):
        monkeypatch.setattr(L, "CHUNK", chunk)
        sums = L.Encoder().sums(texts, list(range(len(texts))), len(texts))
        assert np.array_equal(sums, [plain_bundle(x) for x in texts])


def test_odd_rows(spark):
    rows = [(1, "abc abd abe", "x", 0.5), (1, "abc abd abe", "x", 0.5), (2, None, "x", 1.0), (3, "", "y", 1.0), (None, "42 !?", None, 1.0),
            (4, "xyz xyw", "y", 2.0), (5, "zzz", None, 2.0), (6, "abc abd abe", None, 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = L.train(docs)
    assert sorted(model) == ["x", "y"]
    got = sorted((tuple(x) for x in L.predict(docs, model).select("doc_id", "text", "lang_pred").collect()), key=repr)
    assert len(got) == len(rows)
    assert all(x[2] == "und" for x in got if x[1] in (None, "", "42 !?"))
    assert (6, "abc abd abe", "x") in got and got.count((1, "abc abd abe", "x")) == 2
    assert L.speaks(docs, model).columns == docs.columns
    assert sorted(x["doc_id"] for x in L.speaks(docs, model).collect() if x["doc_id"]) == [1, 1, 4, 6]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert L.train(docs) == {} and L.predict(docs, {}).count() == 0
    one = spark.createDataFrame([(1, "abc", None)], docs.schema)
    assert L.predict(one, {}).select("lang_pred", "score").first() == ("und", 0.0)


def test_limits_count_every_labelled_text(spark):
    """Texts enough that a part of them was looked at before: the lowest cosine of the class is the limit, whichever text has it."""
    docs = spark.range(41_000).selectExpr(
        "id as doc_id", "concat('abcd efgh ', case when id = 17 then 'zq zq zq zq' else concat('abcd ', chr(cast(97 + id % 7 as int)), 'bcde') end) as text", "'x' as lang")
    model = L.train(docs)
    odd = docs.filter("doc_id = 17")
    assert odd.filter("pmod(xxhash64(text), 2) = 1").count() == 1
    cosine = L.predict(odd, model).first()["score"]
    size = int(np.ceil(np.log2(sum(x.isalpha() for x in odd.first()["text"]) + 1)))
    assert L.limits(docs, model, lost=1 / 41_000)[size] == pytest.approx(cosine, abs=1e-6)
