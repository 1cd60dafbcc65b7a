"""Workbooks to predictions, twelve files, then catalog and views over the lake."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from faultline import schemas
from faultline.operators.classify import ClassifierConfig
from faultline.plans import medallion
from xlsx_fixture import workbook_bytes
from faultline.schemas import RAW_COLUMNS
from faultline.sources import catalog, tables
from made_places import PLACED, PLACES

MONTHS = ("JANUARY FEBRUARY MARCH APRIL MAY JUNE JULY AUGUST SEPTEMBER OCTOBER NOVEMBER "
          "DECEMBER").split()
FEEDERS = ["APETE 33KV", "ROM", "SAMANDA 33KV", "T1 15MVA @ AGODI"]
TYPES = ["EDC F/O", "EDC/P/0", "TCN/L/S", "EDC /S"]
CFG = medallion.PipelineConfig(classifier=ClassifierConfig(trees=10, depth=5))
PER_MONTH = 48


def month_rows(m):
    rows = [["Report"], ["mail"]] + [["region"]] * (m % 2)
    rows.append([c if c != "event_no" else "Event No" for c in RAW_COLUMNS])
    for i in range(PER_MONTH):
        if i % 16 == 0:
            rows.append(["33kV FEEDERS OUTAGES"])
        kind = i % 4 if i % 12 else 3
        cells = dict.fromkeys(RAW_COLUMNS)
        cells |= {
            "date_raw": dt.date(2021, m + 1, 1 + i // 2) if i != 5 else dt.date(1900, 1, 7),
            "name_of_affected_feeder": FEEDERS[(i + i // 4) % 4],
            "event_no": i,
            "type_of_outage": TYPES[kind],
            "start_time": dt.time(i % 2 * 12, 30) if i != 7 else None,
            "duration_hours": kind + i % 5 / 10,
            "load_loss_mw": 1.0 + i,
            "no_of_customers_restored": 10,
            "customer_hours_interruption": 2.5,
        }
        rows.append(list(cells.values()))
    return rows


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    raw = root / "raw"
    raw.mkdir()
    for m, name in enumerate(MONTHS):
        book = {"SUMMARY": [["x"]], "RAW MONTHLY": month_rows(m), "REVENUE LOSS": [["y"]]}
        (raw / f"region {name} 2021.xlsx").write_bytes(workbook_bytes(book))
    runs = medallion.run_pipeline(spark, str(raw), str(root / "lake"), CFG)
    return str(root / "lake"), runs


def test_run_metrics(lake):
    _, runs = lake
    total = 12 * (PER_MONTH + 3)
    assert tuple(runs["bronze"].first()) == (total, 12)
    silver = runs["silver"].first()
    assert (silver.clean_rows, silver.quarantined_rows) == (12 * (PER_MONTH - 1), 12 * 4)
    assert silver.unmapped_rows == 12 * 12 - sum(12 for i in (5,) if (i + i // 4) % 4 == 3)
    assert silver.quarantine_ratio == pytest.approx(48 / total)
    gold = runs["gold"].first()
    assert (gold.n_features, gold.n_feeders) == (12 * (PER_MONTH - 1), 3)
    scores = runs["classifier"].first()
    assert scores.classes == ["EDC F/O", "EDC P/O", "TCN L/S"]
    assert scores.accuracy > 0.9 and set(scores.per_class) == set(scores.classes)


def test_halves_are_disjoint_and_whole(spark, lake):
    path, _ = lake
    bronze = tables.read_table(spark, f"{path}/bronze/interruptions", schemas.BRONZE)
    halves = [medallion.read_silver(spark, path, q) for q in (False, True)]
    both = halves[0].unionByName(halves[1]).select(*bronze.columns)
    assert bronze.exceptAll(both).isEmpty() and both.exceptAll(bronze).isEmpty()


def test_reliability_equals_plain_python(spark, lake):
    path, _ = lake
    times, hours = {}, {}
    for m in range(12):
        for i in range(PER_MONTH):
            raw = FEEDERS[(i + i // 4) % 4]
            if i in (5, 7) or raw.startswith("T1"):
                continue
            feeder = {"APETE 33KV": "APETE", "ROM": "ROM", "SAMANDA 33KV": "SAMONDA"}[raw]
            at = dt.datetime(2021, m + 1, 1 + i // 2, i % 2 * 12, 30)
            times.setdefault(feeder, []).append(at)
            kind = i % 4 if i % 12 else 3
            hours.setdefault(feeder, []).append(kind + i % 5 / 10)
    gold = tables.read_table(spark, f"{path}/gold/mttr_mtbf_by_feeder", schemas.RELIABILITY)
    got = {r.feeder_canonical: r for r in gold.collect()}
    assert set(got) == set(times)
    for feeder, stamps in times.items():
        stamps.sort()
        gaps = [(b - a).total_seconds() / 3600 for a, b in zip(stamps, stamps[1:])]
        r = got[feeder]
        assert r.total_outages == len(stamps)
        assert r.mtbf_hours == pytest.approx(sum(gaps) / len(gaps), abs=0.0051)
        assert r.mttr_hours == pytest.approx(sum(hours[feeder]) / len(stamps), abs=0.0051)
        assert r.total_customer_hours_interruption == pytest.approx(2.5 * len(stamps))


def test_one_half_is_read_by_folder(spark, lake, plan_of):
    plan = plan_of(medallion.read_silver(spark, lake[0]))
    assert "PartitionFilters: [isnotnull(quarantined" in plan


def test_catalog_and_views(spark, lake, tmp_path):
    path, _ = lake
    places = spark.createDataFrame(PLACES, schemas.LOCATIONS)
    csv = str(tmp_path / "places")
    places.write.option("header", "true").option("escape", '"').csv(csv)
    catalog.register_lake(spark, "lake_test", path, csv)
    assert spark.table("lake_test.interruptions_clean").count() == 12 * (PER_MONTH - 1)
    assert spark.table("lake_test.interruptions_quarantine").count() == 48
    months = spark.sql("SHOW PARTITIONS lake_test.classifier_features").count()
    assert months == 12
    kinds = {f.dataType.typeName() for f in spark.table("lake_test.feeder_locations").schema}
    assert kinds == {"string"}
    names = catalog.create_views(spark, "lake_test")
    assert len(names) == 4
    other = spark.newSession()  # the views are the catalog's, not the session's
    board = other.sql("SELECT * FROM lake_test.mttr_mtbf_leaderboard ORDER BY reliability_rank LIMIT 10")
    gaps = [r.mtbf_hours for r in board.collect()]
    assert gaps == sorted(gaps) and len(gaps) == 3
    ranks = [r.reliability_rank for r in board.collect()]
    assert ranks == [1 + sum(g < h for g in gaps) for h in gaps]
    where = {r.feeder_canonical: r.location_wkt for r in other.table("lake_test.feeder_reliability_map").collect()}
    assert where.get("SAMONDA", "POINT (3.5 7.25)") == "POINT (3.5 7.25)"
    assert all((where[f] is None) == (f not in PLACED) for f in where)
    summary = other.table("lake_test.outage_type_summary")
    assert summary.agg(F.sum("total_events")).first()[0] == 12 * (PER_MONTH - 1) - 144
    assert other.table("lake_test.classifier_accuracy_by_type").count() == 3


def test_a_name_registered_again_reads_the_new_folder(spark, tmp_path):
    for v in (1, 2):
        path = str(tmp_path / str(v))
        rows = spark.createDataFrame([(v,)], "v int")
        tables.write_table(rows, path)
        catalog.create_parquet_table(spark, "default", "moved", rows.schema, path)
        assert [r.v for r in spark.table("moved").collect()] == [v]
    assert spark.read.parquet(str(tmp_path / "1")).count() == 1
    spark.sql("DROP TABLE moved")


def test_new_partition_shows_after_refresh(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "MAY")], "v int, source_month string")
    tables.write_table(rows, path, "source_month")
    catalog.create_parquet_table(spark, "default", "refresh_me", rows.schema, path, "source_month")
    assert spark.table("refresh_me").count() == 1
    more = spark.createDataFrame([(2, "JUNE")], rows.schema)
    tables.write_table(more, path, "source_month", replace_only_written=True)
    assert spark.table("refresh_me").count() == 1
    catalog.refresh_partitions(spark, "default", "refresh_me")
    assert spark.table("refresh_me").count() == 2


def test_a_second_run_replaces_the_lake(spark, lake):
    path, _ = lake
    assert medallion.refine_silver(spark, path, CFG).first().clean_rows == 12 * (PER_MONTH - 1)
    wide = medallion.PipelineConfig(year=1900, classifier=CFG.classifier)
    other = path + "-1900"
    bronze = tables.read_table(spark, f"{path}/bronze/interruptions", schemas.BRONZE)
    tables.write_table(bronze, f"{other}/bronze/interruptions", "source_month")
    assert medallion.refine_silver(spark, other, wide).first().clean_rows == 12
