import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faultline.functions import text
from faultline.operators import quality, quarantine
from faultline.functions.rules import CANONICAL_FEEDERS
from made_places import PLACES
from faultline.schemas import BRONZE, LOCATIONS, SILVER

DATES = ["2021-01-05 00:00:00", "2021-12-31", "2021", "1900-01-07 00:00:00", "2022-01-01",
         "33kV FEEDERS OUTAGES", "05/01/2021", "nan", None]


def flagged(spark, dates):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "i int, raw string")
    return quarantine.with_quarantine_flag(df.withColumn("d", text.to_date("raw")), "d", 2021)


def test_dates_outside_the_year_are_rejected(spark):
    clean, rejected = quarantine.split_quarantine(flagged(spark, DATES))
    assert [r.i for r in clean.orderBy("i").collect()] == [0, 1, 2]
    assert [r.i for r in rejected.orderBy("i").collect()] == [3, 4, 5, 6, 7, 8]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from(DATES) | st.text(max_size=12), max_size=30))
def test_both_halves_make_the_whole(spark, dates):
    whole = flagged(spark, dates)
    clean, rejected = quarantine.split_quarantine(whole)
    rows = whole.drop("quarantined")
    both = clean.unionAll(rejected)
    assert rows.exceptAll(both).isEmpty() and both.exceptAll(rows).isEmpty()


def test_silver_types_and_names(spark, plan_of):
    row = dict.fromkeys(BRONZE.names)
    row |= {"date_raw": "2021-01-05", "name_of_affected_feeder": "SAMANDA 33KV", "event_no": "12.0",
            "type_of_outage": "EDC/P/0", "duration_hours": "1.5", "load_loss_mw": "nan"}
    bronze = spark.createDataFrame([tuple(row.values())] * 2, BRONZE)
    silver = quarantine.to_silver(bronze, 2021)
    assert silver.schema.names == [*SILVER.names, "quarantined"]
    got = silver.first()
    assert (got.feeder_canonical, got.outage_type_canonical) == ("SAMONDA", "EDC P/O")
    assert (got.duration_hours_num, got.load_loss_mw_num, got.event_no_num) == (1.5, None, 12)
    assert not got.is_transformer_event and not got.quarantined
    assert "Python" not in plan_of(silver)
    assert silver.exceptAll(quarantine.to_silver(bronze, 2021, stored=True)).isEmpty()


def test_metrics_in_one_pass(spark, plan_of):
    df = flagged(spark, DATES).withColumn("u", F.col("i") == 0)
    metrics = quarantine.quarantine_metrics(df, unmapped=F.col("u"))
    assert tuple(metrics.first()) == (3, 6, 1, pytest.approx(6 / 9))
    assert plan_of(metrics).count("Scan") == 1
    empty = quarantine.quarantine_metrics(df.limit(0)).first()
    assert (empty.clean_rows, empty.quarantine_ratio) == (0, None)


def locations(spark):
    return spark.createDataFrame(PLACES, LOCATIONS)


def test_reference_locations_hold(spark):
    places = locations(spark)
    names = spark.createDataFrame([(n,) for n in CANONICAL_FEEDERS], "feeder_canonical string")
    assert quality.key_violations(places, names, "feeder_canonical").isEmpty()
    assert quality.domain_violations(places).isEmpty()
    assert quality.location_violations(places).isEmpty()
    assert quality.box_violations(places).isEmpty()
    assert quality.blank_violations(places).isEmpty()


def test_planted_faults_are_found(spark):
    rows = [
        ("ROM", 7.4, 3.9, None, "high", "urban", "x"),
        ("ROM", 3.9, 7.4, 2.5, "low", "urban", " "),
        ("APATA", 7.4, None, None, "unlocated", None, "x"),
        ("APETE", 7.4, 3.9, 2.5, "sure", None, None),
    ]
    df = spark.createDataFrame(rows, LOCATIONS)
    names = spark.createDataFrame([("ROM",), ("APETE",), ("LIBERTY",)], "feeder_canonical string")
    found = quality.key_violations(df, names, "feeder_canonical").collect()
    assert {(r.feeder_canonical, r.problem) for r in found} == {
        ("ROM", "duplicate"), ("APATA", "unknown"), ("LIBERTY", "missing"),
    }
    assert [r.confidence for r in quality.domain_violations(df).collect()] == ["sure"]
    assert sorted(r.problem for r in quality.location_violations(df).collect()) == [
        "located_incomplete", "unlocated_with_coordinates",
    ]
    assert [r.latitude for r in quality.box_violations(df).collect()] == [3.9]
    assert quality.blank_violations(df).count() == 2
