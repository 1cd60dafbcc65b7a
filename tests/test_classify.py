import hashlib
import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from faultline.operators import classify, summaries
from faultline.operators.classify import ClassifierConfig

FEATURES = (
    "feeder_canonical string, outage_type_canonical string, duration_hours_num double, "
    "load_loss_mw_num double, no_of_customers_restored_num double, "
    "customer_hours_interruption_num double, event_no_num int, is_transformer_event boolean, "
    "source_month string, id long"
)


def features(spark, n=400):
    kinds = ["EDC F/O", "EDC P/O", "TCN F/O"]
    rows = [
        ("ROM" if i % 2 else "APETE", kinds[i % 3], float(i % 3 * 10 + i % 4), 1.0 + i % 5, 3.0,
         2.0, i, False, "MAY", i)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, FEATURES)


def labels(spark, sizes):
    rows, i = [], 0
    for name, n in sizes.items():
        for _ in range(n):
            rows.append((i, name))
            i += 1
    return spark.createDataFrame(rows, "id long, label string")


def expected_test_ids(sizes, fraction=0.2, seed=42):
    total = sum(sizes.values())
    n_train = total - math.ceil(fraction * total)
    train = {c: n * n_train // total for c, n in sizes.items()}
    by_rest = sorted(sizes, key=lambda c: (-(sizes[c] * n_train % total), c))
    for c in by_rest[: n_train - sum(train.values())]:
        train[c] += 1
    out, i = set(), 0
    for c, n in sizes.items():
        ids = sorted(range(i, i + n), key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())
        out |= set(ids[: n - train[c]])
        i += n
    return out


@pytest.mark.parametrize("prefix", [4, 1])
@pytest.mark.parametrize(
    "sizes", [{"a": 700, "b": 33, "c": 2}, {"x": 5, "y": 5}, {"a": 101, "b": 99, "c": 3, "d": 7}]
)
def test_split_is_exact(spark, monkeypatch, sizes, prefix):
    monkeypatch.setattr(classify, "HASH_PREFIX", prefix)
    split = classify.stratified_split(labels(spark, sizes), "label", "id")
    rows = split.collect()
    assert len(rows) == sum(sizes.values())
    assert {r.id for r in rows if r.is_test} == expected_test_ids(sizes)


@pytest.mark.parametrize(
    "sizes, message",
    [({"a": 50, "b": 1}, "fewer than 2 rows"), ({"a": 3, "b": 2, "c": 2}, "fewer test rows")],
)
def test_split_guards(spark, sizes, message):
    with pytest.raises(Exception, match=message):
        classify.stratified_split(labels(spark, sizes), "label", "id").collect()


def test_many_classes(spark):
    df = spark.range(50_000 * 12).selectExpr("id", "concat('c', id % 50000) AS label")
    numbers = classify.label_encode(df, "label", "x").select("label", "x").distinct()
    assert numbers.count() == numbers.select("x").distinct().count() == 50_000
    split = classify.stratified_split(df, "label", "id")
    per_class = split.groupBy("label").agg(F.count_if("is_test").alias("n"))
    assert split.filter("is_test").count() == 120_000
    assert {r.n for r in per_class.select("n").distinct().collect()} == {2, 3}


def test_split_sizes_of_huge_classes(spark):
    counts = spark.createDataFrame([("a", 4 * 10**12), ("b", 10**12), ("c", 5)], "label string, n long")
    rows = {r.label: r for r in classify.split_sizes(counts, "label", 0.2).collect()}
    assert sum(r.n_test for r in rows.values()) == math.ceil(0.2 * (5 * 10**12 + 5))
    assert (rows["c"].n_train, rows["c"].n_test) == (4, 1)


def test_split_meets_the_rows_once(spark, plan_of):
    wide = labels(spark, {"a": 20, "b": 20}).withColumn("payload", F.lit("x"))
    plan = plan_of(classify.stratified_split(wide, "label", "id"))
    assert plan.count("Join") == 1 and "Window" not in plan


def test_split_summary(spark):
    split = classify.stratified_split(labels(spark, {"b": 20, "a": 30}), "label", "id")
    assert tuple(classify.split_summary(split, "label").first()) == (40, 10, ["a", "b"])


def test_labeled_rows(spark):
    df = features(spark, 6)
    i = F.col("id")
    df = df.withColumns(
        {
            "is_transformer_event": i == 0,
            "outage_type_canonical": F.when(i == 1, "OTHER").otherwise("EDC F/O"),
            "load_loss_mw_num": F.when(i == 2, F.lit(float("nan"))).otherwise(1.0),
            "event_no_num": F.when(i != 3, i.cast("int")),
        }
    )
    assert [r.id for r in classify.labeled_rows(df).collect()] == [4, 5]


def test_row_ids_are_unique(spark):
    df = classify.with_row_ids(features(spark).drop("id"))
    assert df.select("row_id").distinct().count() == 400


def test_label_encode_and_one_hot(spark):
    df = labels(spark, {"b": 2, "a": 1})
    assert [r.x for r in classify.label_encode(df, "label", "x").orderBy("id").collect()] == [1, 1, 0]
    hot = classify.one_hot(df, "label", ["a", "b"], "is")
    assert hot.columns == ["id", "label", "is_a", "is_b"]
    assert [(r.is_a, r.is_b) for r in hot.orderBy("id").collect()] == [(0, 1), (0, 1), (1, 0)]


def test_default_is_boosted():
    cfg = ClassifierConfig()
    assert (cfg.kind, cfg.depth, cfg.trees, cfg.learning_rate) == ("boosted", 6, 200, 0.1)


CFG = ClassifierConfig(kind="forest", trees=10, depth=4)


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_train_and_predict(spark, kind, tmp_path):
    cfg = replace(CFG, kind=kind)
    model, predictions, split = classify.train_and_predict(features(spark), "id", cfg)
    assert predictions.columns == [
        "feeder_canonical", "outage_type_canonical", "source_month", "predicted_outage_type", "correct",
    ]
    assert predictions.count() == 80
    assert classify.overall_accuracy(predictions).first().accuracy > 0.9
    classify.save_model(spark, model, str(tmp_path / "model"))
    again = classify.load_model(spark, str(tmp_path / "model"), cfg)
    assert classify.predict(again, split.filter("is_test"), cfg).exceptAll(predictions).isEmpty()


def test_metrics_document(spark):
    _, predictions, split = classify.train_and_predict(features(spark), "id", CFG)
    doc = classify.metrics_document(split, predictions, CFG).first()
    assert (doc.train_rows, doc.test_rows) == (320, 80)
    assert doc.classes == ["EDC F/O", "EDC P/O", "TCN F/O"]
    assert set(doc.per_class) == set(doc.classes)
    assert 0.9 < doc.accuracy <= 1.0 and doc.per_class["EDC F/O"].recall > 0.9


def test_class_report_without_cases_is_zero(spark):
    df = spark.createDataFrame(
        [("a", "a"), ("a", "b"), ("b", "a"), ("c", "a")],
        "outage_type_canonical string, predicted_outage_type string",
    )
    got = {r["class"]: (r.precision, r.recall, round(r.f1, 4), r.support)
           for r in classify.class_report(df).collect()}
    assert got == {"a": (1 / 3, 0.5, 0.4, 2), "b": (0.0, 0.0, 0.0, 1), "c": (0.0, 0.0, 0.0, 1)}


def test_accuracy_by_class(spark):
    df = spark.createDataFrame(
        [("a", True), ("a", False), ("a", True), ("b", False)],
        "outage_type_canonical string, correct boolean",
    )
    assert sorted(tuple(r) for r in summaries.accuracy_by_class(df).collect()) == [
        ("a", 3, 2, 66.7), ("b", 1, 0, 0.0),
    ]


def test_ablation_shows_the_leak(spark):
    df = features(spark).withColumns(
        {"duration_hours_num": F.lit(1.0), "cause": F.col("outage_type_canonical")}
    )
    variants = {"without": CFG, "with": replace(CFG, categorical=(*CFG.categorical, "cause"))}
    accuracy = {r.features: r.accuracy for r in classify.ablation(df, "id", variants).collect()}
    assert accuracy["with"] > accuracy["without"] + 0.3


def test_leak_probe_ranks_the_cause_first(spark):
    i = F.col("id")
    df = features(spark).withColumns(
        {
            "cause": F.when(i % 40 != 0, F.concat(F.lit("by "), "outage_type_canonical")),
            "nothing": F.lit(None).cast("string"),
            "constant": F.lit(7.0),
        }
    )
    found = classify.leak_probe(
        df, "outage_type_canonical", ("duration_hours_num", "constant"), ("feeder_canonical", "cause", "nothing")
    )
    rows = {r.feature: r for r in found.collect()}
    assert max(rows, key=lambda f: rows[f].explained) == "duration_hours_num"  # fixes the type here
    assert rows["cause"].explained > 0.9 > 0.01 > rows["feeder_canonical"].explained
    assert rows["constant"].explained == rows["nothing"].explained == 0 and rows["nothing"].n_values == 1
    assert rows["cause"].label_bits == pytest.approx(math.log2(3), abs=1e-3) and rows["cause"].n_values == 4
    assert classify.leak_probe(df.limit(0), "outage_type_canonical", (), ("cause",)).isEmpty()
