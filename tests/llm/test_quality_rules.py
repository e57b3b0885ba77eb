from __future__ import annotations

import re
from collections import defaultdict

import pytest

from starhouse.llm import quality_rules as Q

SCHEMA = "doc_id long, text string, source string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, least, share, depleted):
    """The verdicts by reading the rules, with texts and lines themselves instead of digests."""
    def form(line):
        low = "".join(x.lower() if "A" <= x <= "Z" else x for x in line)
        return re.sub("[0-9]+", "0", " ".join(WORD.findall(low)))

    texts, holders = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        texts[host].add(text or "")
        for line in (text or "").split("\n"):
            if form(line):
                holders[host, form(line)].add(text)
    out = []
    for doc_id, text, host in rows:
        words = WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
        repeated = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)}
        lost = sum(len(WORD.findall(x)) for x in lines if (n := len(holders[host, form(x)])) > least and n > share * len(texts[host]))
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        out.append((
            doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated),
            lost, failed, not failed and 100 * lost <= depleted * len(words)))
    return sorted(out, key=repr)


def prose(seed, n):
    numbers = " ".join(str((seed * 7919 + k * 104729) % 99991) for k in range(n))
    return numbers.translate(str.maketrans("0123456789", "abcdefghij"))


@pytest.fixture(scope="module")
def rows():
    menu, legal = "Home | News | Page 3 of 12", "All rights reserved " + prose(5, 60)
    out = [(k, f"{menu.replace('3', str(k))}\n{prose(k, 70)}\n\n{legal if k % 3 == 0 else prose(k + 500, 9)}", "a") for k in range(30)]
    out += [(100 + k, f"  HOME |\tnews | page 7 of {k}\n{prose(900, 80)}", "b") for k in range(30)]  # equal forms, another host
    out += [(200 + k, f"{prose(77, 60)}\n{prose(78, 60)}", "a") for k in range(40)]  # copies of one text
    out += [(300 + k, f"{legal}\nshort {k}", None) for k in range(12)]  # a host of its own: no name
    return out + [
        (400, None, "a"), (401, "", "a"), (402, " \n\t\n", "b"), (403, "one\ntwo\none\n one", "a"), (404, "a b c " * 30, "a"),
        (405, "日本語のテキスト　全角 #* É é\v\x1c\x85 x\f&" + prose(3, 60), "a"), (None, prose(1, 60), "a"), (None, prose(1, 60), "a"),
        (406, prose(9, 40_000), "c"), (400, prose(6, 55), "a"),
    ]


LIMITS = {"least": 8, "share": 0.05, "depleted": 40}


def test_verdicts_equal_plain_reading_of_the_rules(spark, rows):
    found = Q.judge(spark.createDataFrame(rows, SCHEMA).repartition(5), **LIMITS).drop("source")
    expected = plain([x for x in rows if x[0] != 406], **LIMITS)
    assert sorted((tuple(x) for x in found.filter("doc_id is null or doc_id != 406").collect()), key=repr) == expected
    assert found.filter("doc_id = 406").first()["n_words"] == 40_000
    verdict = {x[0]: x for x in expected}
    assert verdict[0][6] > 60 and not verdict[0][8] and verdict[1][6] == 8 and verdict[1][8]  # depleted; only the menu lost
    assert verdict[200][6] == 0 and verdict[200][8]  # copies alone make no line frequent


def test_cleaning_removes_frequent_lines_alone(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as no", "2 as row", "3 as `a.b`", "4 as line")
    found = {x["doc_id"]: x for x in Q.cleaned(docs, **LIMITS).collect() if x["doc_id"] is not None}
    kept = {x[0] for x in plain([x for x in rows if x[0] != 406], **LIMITS) if x[8] and x[0] is not None} | {406}
    assert set(found) == kept and found[1].asDict().keys() == set(docs.columns)
    assert found[1]["text"] == rows[1][1].split("\n", 1)[1] and found[200]["text"] == rows[60][1]
    assert (found[1]["no"], found[1]["row"], found[1]["a.b"], found[1]["line"]) == (1, 2, 3, 4)


def test_empty_table_and_clashing_columns(spark):
    assert Q.judge(spark.createDataFrame([], SCHEMA)).count() == 0
    assert Q.cleaned(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([(1, prose(1, 60), "h", "mine", 5)], SCHEMA + ", kept string, digest int")
    row = Q.judge(docs).first()
    assert row["kept"] is True and row["digest"] == 5 and "text" not in row
