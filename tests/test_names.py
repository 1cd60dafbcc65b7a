import random

import pytest
from pyspark.sql import functions as F

from faultline.operators import names


def lookup(spark, keys, listed, **how):
    keys = spark.createDataFrame([(k,) for k in keys], "raw string").distinct()
    listed = spark.createDataFrame(list(enumerate(listed)), "place long, bare string")
    return {r["key"]: r["position"] for r in names.first_containing(keys, "raw", listed, "bare", "place", **how).collect()}


def brute(keys, listed, min_reverse_len=0):
    out = {}
    for k in set(keys) - {None}:
        for i, name in enumerate(listed):
            if name is not None and (name in k or (k in name and len(k) >= min_reverse_len)):
                out[k] = i
                break
    return out


@pytest.mark.parametrize("min_reverse_len", [0, 1, 3])
@pytest.mark.parametrize("empty_name", [False, True])
def test_first_containing(spark, min_reverse_len, empty_name):
    dice = random.Random(5)

    def word(n):
        return "".join(dice.choice("abc") for _ in range(n))

    listed = [word(dice.randrange(1, 9)) for _ in range(60)] + [None, "漢字", "漢", "zz"]
    listed += [""] * empty_name + ["behind"]
    keys = [word(dice.randrange(0, 14)) for _ in range(400)] + [None, "", "z", "zz", "zzz", "x漢字x", "字", "nothing"]
    keys += [n + word(2) for n in listed if n]
    got = lookup(spark, keys, listed, min_reverse_len=min_reverse_len)
    assert got == brute(keys, listed, min_reverse_len)


def test_what_meets_grows_with_the_rows(spark):
    """Every part of three characters is shared by a tenth of the names and more, and still no key meets them."""

    def met(n):
        listed = [f"aaaa{i:05d}aaaa" for i in range(10_000, 10_000 + n)]
        keys = [f"x{name}y" for name in listed] + [name[2:] for name in listed]
        keys = spark.createDataFrame([(k,) for k in keys], "raw string")
        table = spark.createDataFrame(list(enumerate(listed)), "place long, bare string")
        found = names.first_containing(keys, "raw", table, "bare", "place")
        assert found.count() == 2 * n
        found.collect()
        nodes, most = [found._jdf.queryExecution().executedPlan()], 0
        while nodes:
            node = nodes.pop()
            if node.nodeName().startswith("AdaptiveSparkPlan"):
                nodes.append(node.executedPlan())
            elif node.nodeName().endswith("QueryStage"):
                nodes.append(node.plan())
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]
            if "Join" in node.nodeName():
                most = max(most, node.metrics().apply("numOutputRows").value())
        return most

    assert met(1000) <= 4 * 1000


def test_empty_tables(spark):
    assert lookup(spark, ["a"], []) == {} and lookup(spark, [], ["a"]) == {}
    assert lookup(spark, [None], [None]) == {}


def test_rows_keep_their_columns_and_repeats(spark):
    df = spark.createDataFrame([(1, "agodi2x"), (2, None), (2, None), (3, "agodi2x"), (4, "rom")], "k int, raw string")
    listed = spark.createDataFrame([(0, "AGODI 1", "agodi1"), (1, "AGODI 2", "agodi2")], "p long, label string, bare string")
    got = names.with_listed_name(df, "raw", listed, "label", "bare", "p", "found")
    assert got.columns == ["k", "raw", "found"]
    assert sorted(map(tuple, got.collect()), key=repr) == [
        (1, "agodi2x", "AGODI 2"), (2, None, None), (2, None, None), (3, "agodi2x", "AGODI 2"), (4, "rom", None),
    ]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [1, 2])
@pytest.mark.parametrize("variant_rows", [2000, 3])
def test_proposed_names(spark, monkeypatch, most, variant_rows):
    monkeypatch.setattr(names, "VARIANT_ROWS", variant_rows)
    dice = random.Random(7)
    listed = ["", "a", "ab", "rom", "apata", "apete", "eleyele", "漢字", "interchange", "agodi 1", "agodi 2"]
    spelt = set(listed)
    for _ in range(200):
        word = list(dice.choice(listed))
        for _ in range(dice.randrange(4)):
            at = dice.randrange(len(word) + 1)
            word[at : at + dice.randrange(2)] = dice.choice(["", "x", "a", "yz"])
        spelt.add("".join(word))
    spellings = spark.createDataFrame([(s,) for s in [*spelt, None]], "raw string")
    table = spark.createDataFrame([(n,) for n in [*listed, None]], "label string")
    got = {(r[0], r[1], r[2]) for r in names.proposed_names(spellings, "raw", table, "label", most).collect()}
    assert got == {(s, n, d) for s in spelt for n in listed if (d := distance(s, n)) <= most}


def test_proposals_carry_their_rows(spark):
    audit = spark.createDataFrame([("apaat", 5), ("nothing like it", 9)], "raw string, n_rows long")
    table = spark.createDataFrame([("apata",), ("rom",)], "label string")
    got = names.proposals(audit, "raw", table, "label")
    assert [tuple(r) for r in got.collect()] == [("apaat", "apata", 2, 5)]
    assert names.proposals(audit.filter(F.lit(False)), "raw", table, "label").isEmpty()
