import math
import random

import numpy as np
import pyarrow as pa
import pytest

from faultline.operators import boosting
from faultline.operators.boosting import Boosting, Model

SCHEMA = "id long, x double, y double, kind string, label string"


def rows(n, seed=1):
    dice = random.Random(seed)
    out = []
    for i in range(n):
        x, y, kind = dice.randrange(12) / 2, dice.gauss(0, 1), dice.choice("pqr")
        side = (x > 3) != (y > 0)
        out.append((i, x, y, kind, "odd" if kind == "q" and x > 1 else "a" if side else "b"))
    return out


def brute(data, features, labels, how):
    """Softmax boosting on lists: the margins of every row after all rounds."""
    margins = [[0.0] * len(labels) for _ in data]

    def sides(values, f, cut):
        if f.categorical:
            return [v == f.cuts[cut] for v in values]
        return [v > f.cuts[cut] for v in values]

    def build(members, g, h, depth):
        total_g, total_h = sum(g[i] for i in members), sum(h[i] for i in members)
        best = (how.least_gain, None, None)
        if depth < how.depth and total_h >= (2 * how.least_weight if depth else 0):
            for c, f in enumerate(features):
                for cut in range(len(f.cuts)):
                    right = [i for i, r in zip(members, sides([data[i][c] for i in members], f, cut)) if r]
                    left = [i for i in members if i not in set(right)]
                    parts = [(sum(g[i] for i in p), sum(h[i] for i in p)) for p in (left, right)]
                    if any(w < how.least_weight for _, w in parts):
                        continue
                    gain = sum(a * a / (b + how.l2) for a, b in parts) - total_g**2 / (total_h + how.l2)
                    if gain > best[0] + 1e-9:
                        best = (gain, left, right)
        if best[1] is None:
            value = -how.rate * total_g / (total_h + how.l2)
            return {i: value for i in members}
        return build(best[1], g, h, depth + 1) | build(best[2], g, h, depth + 1)

    unit = 1 << 24
    for _ in range(how.rounds):
        p = [[math.exp(m - max(own)) for m in own] for own in margins]
        p = [[x / sum(own) for x in own] for own in p]
        added = []
        for k, label in enumerate(labels):
            g = [round((own[k] - (r[-1] == label)) * unit) / unit for own, r in zip(p, data)]
            h = [round(2 * own[k] * (1 - own[k]) * unit) / unit for own in p]
            added.append(build(list(range(len(data))), g, h, 0))
        for i, own in enumerate(margins):
            for k in range(len(labels)):
                own[k] += added[k][i]
    return margins


def batch_of(spark, df):
    return df.toArrow().to_batches()[0]


def test_against_lists(spark):
    how = Boosting(rounds=4, depth=3, rate=0.3, renew=3)
    df = spark.createDataFrame(rows(120), SCHEMA).coalesce(1)
    model = boosting.fit(df, ["x", "y"], ["kind"], "label", how)
    assert model.labels == ["a", "b", "odd"] and len(model.rounds) == 4
    data = [r[1:] for r in rows(120)]
    want = brute(data, model.features, model.labels, how)
    got = model.margins(batch_of(spark, df.orderBy("id")))
    assert np.abs(got - np.array(want)).max() < 1e-5


def same(a: Model, b: Model):
    return a.labels == b.labels and a.features == b.features and all(
        (x.feature == y.feature).all() and (x.cut == y.cut).all() and (x.value == y.value).all()
        for x, y in zip(a.rounds, b.rounds, strict=True)
    )


def test_model_does_not_depend_on_partitions_blocks_or_renewal(spark):
    df = spark.createDataFrame(rows(900), SCHEMA)
    names = (["x", "y"], ["kind"], "label")
    one = boosting.fit(df.coalesce(1), *names, Boosting(rounds=7, depth=4))
    two = boosting.fit(df.repartition(9), *names, Boosting(rounds=7, depth=4, block_rows=13, renew=2))
    assert same(one, two)


def test_learns_what_no_single_feature_tells(spark, tmp_path):
    df = spark.createDataFrame(rows(3000), SCHEMA)
    model = boosting.fit(df, ["x", "y"], ["kind"], "label", Boosting(rounds=30, depth=4))
    fresh = spark.createDataFrame(rows(1000, seed=2), SCHEMA)
    found = model.predict(fresh, ["id", "label"], "found")
    assert found.columns == ["id", "label", "found"]
    assert found.filter("label = found").count() > 970
    model.save(spark, str(tmp_path / "model"))
    again = Model.load(spark, str(tmp_path / "model"))
    assert again.predict(fresh, ["id", "label"], "found").exceptAll(found).isEmpty()


def test_odd_values(spark):
    df = spark.createDataFrame(rows(400), SCHEMA)
    how = Boosting(rounds=3, depth=2)
    model = boosting.fit(df, ["x", "y"], ["kind"], "label", how)
    odd = [(1, None, float("nan"), None, None), (2, 1e300, -math.inf, "never seen", "a"), (3, math.inf, 0.0, "q", "zz")]
    assert model.predict(spark.createDataFrame(odd, SCHEMA), ["id"], "found").count() == 3
    assert model.predict(df.limit(0), ["id"], "found").count() == 0
    with_gaps = df.union(spark.createDataFrame([(9, 1.0, 1.0, "p", None)], SCHEMA))
    assert same(boosting.fit(with_gaps, ["x", "y"], ["kind"], "label", how), model)
    # nothing to split by: the most frequent label
    flat = boosting.fit(df, [], [], "label", how)
    most = df.groupBy("label").count().orderBy("count").tail(1)[0]["label"]
    assert {r.found for r in flat.predict(df, ["id"], "found").collect()} == {most}
    with pytest.raises(ValueError):
        boosting.fit(df.limit(0), ["x"], [], "label", how)


def counted_passes(monkeypatch):
    passes, inner = [], boosting.passed
    monkeypatch.setattr(boosting, "passed", lambda *a: passes.append(1) or inner(*a))
    return passes


def test_passes_are_at_most_rounds_times_depth(spark, monkeypatch):
    passes = counted_passes(monkeypatch)
    df = spark.createDataFrame(rows(500), SCHEMA)
    boosting.fit(df, ["x", "y"], ["kind"], "label", Boosting(rounds=5, depth=3))
    assert 5 <= len(passes) <= 15


def test_the_round_before_saves_passes_and_changes_nothing(spark, monkeypatch):
    df = spark.createDataFrame(rows(500), SCHEMA).coalesce(2)
    names, how = (["x", "y"], ["kind"], "label"), Boosting(rounds=8, depth=3)
    passes = counted_passes(monkeypatch)
    model = boosting.fit(df, *names, how)
    saved = len(passes)
    passes.clear()
    inner = boosting.grow
    blind = lambda blocks, since, before, *a: inner(blocks, since, None, *a)
    monkeypatch.setattr(boosting, "grow", blind)
    assert same(boosting.fit(df, *names, how), model)
    assert saved < len(passes)


def test_trees_with_the_same_splits_are_walked_once(spark, monkeypatch):
    """A pass costs the same however many rounds came since the margins were written."""
    trees = boosting.Trees.empty(2, 3)
    trees.feature[:, :3], trees.cut[:, :3] = [[0, 1, -1]], [[4, 2, 0]]
    trees.value[:] = np.arange(15) / 8
    bins = np.array([[0, 4, 5, 9], [2, 3, 2, 7]], np.uint8)
    categorical = np.array([False, True])
    found = boosting.merged([trees] * 9, categorical, 2)
    assert [len(own) for own in found] == [1, 1]
    margins = np.zeros((2, 4))
    last = boosting.add_to(margins, bins, found)
    assert [at.tolist() for own in last for at in own.values()] == [[4, 3, 2, 2]] * 2
    assert margins.tolist() == [[x * 9 / 8 for x in (4, 3, 2, 2)]] * 2

    added = []
    inner = boosting.Pass.add
    monkeypatch.setattr(boosting.Pass, "add", lambda self, out, slot, *a: added.append(len(slot)) or inner(self, out, slot, *a))
    labels = np.array([0, 1, 0, 1], np.int32)
    columns = [[x.tobytes()] for x in (bins, labels, np.zeros((2, 4)))]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["bins", "labels", "margins"])
    walks = [(trees.splits(k), boosting.Walk.of(trees.feature[k], trees.cut[k], categorical)) for k in range(2)]
    slots = np.array([[0, 1, 2] + [1] * 4 + [2] * 8, [3, 4, 5] + [4] * 4 + [5] * 8])
    sums = boosting.Pass(found, walks, slots, [10, 8]).histograms([batch])
    assert added == [4, 4]  # each row once per class, not once per level
    assert sums.shape == (6, 18, 2) and not sums[0].any() and sums[1, :, 1].sum() > 0


def test_blocks_are_full(spark):
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n))], ["x"]) for n in (3, 0, 10, 1)]
    got = [b.column("x").to_pylist() for b in boosting._filled(batches, 4)]
    assert [len(x) for x in got] == [4, 4, 4, 2] and sum(got, []) == [0, 1, 2, *range(10), 0]
