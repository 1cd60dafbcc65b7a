import re

import pytest
from llm_cases import CLASH, ascii_lower, odd_texts, table

from faultline.llm.licenses import BASE, NOTICES, Template, scan, summary

NOTICE = next(t for t in NOTICES if t.label == "mit").text
TEXTS = [
    (1, "Released under the MIT License."),
    (2, "Licensed under CC BY-NC 4.0. cc-by-nc! under the mit license under the MIT license"),
    (3, "Apache License, Version 2.0; not apache licence version 2"),
    (4, "under the mit cc by any nc license"),
    (5, f"Copyright. {NOTICE}. End"),
    (6, NOTICE.replace("copy", "clone")),
    (7, NOTICE.replace("restriction", "limits")),
    (8, "Underſ the mİt license; under the ＭIT license; Kelvin K under the mit licensé"),
    (9, "all rights reserved " * 200),
]


def brute(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(text))
    begins, base, labels, score = [], set(), set(), 0.0
    for t in BASE + NOTICES:
        own, n = [], len(t.words)
        for at in range(-n, len(words)):
            if all(0 <= at + i < len(words) and words[at + i] == t.words[i] for i in t.key_offsets):
                own.append(at)
        if own:
            labels.add(t.label)
            if t.base:
                begins += own
                base.add(t.label)
            there = sum(
                any(0 <= at + i < len(words) and words[at + i] == w for at in own) for i, w in enumerate(t.words)
            )
            score = max(score, there / n)
    ends = (min(begins), max(begins)) if begins else (None, None)
    return (len(words), len(begins), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score)


def test_against_brute_force(spark):
    rows = TEXTS + [(None if i is None else 100 + i, t) for i, t in odd_texts()]
    got = summary(scan(table(spark, rows)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((i, *brute(t)) for i, t in rows), key=repr)


def test_expected_labels(spark):
    got = {r["doc_id"]: r for r in summary(scan(table(spark, TEXTS))).collect()}
    assert (got[2]["n_base"], got[2]["base_labels"]) == (4, "cc-by-nc,mit")
    assert got[4]["labels"] == "" and got[5]["labels"] == "mit" and got[5]["n_base"] == 0
    assert got[6]["score"] == pytest.approx(1 - 1 / len(NOTICE.split())) and got[7]["labels"] == ""


def test_other_columns_stay_and_empty_tables_pass(spark):
    df = table(spark, TEXTS)
    assert set(CLASH) <= set(scan(df).columns) and scan(df.limit(0)).count() == 0


def test_key_phrases_have_places():
    assert Template("x", "a b c d", ("b c", "d")).key_offsets == [1, 2, 3]
