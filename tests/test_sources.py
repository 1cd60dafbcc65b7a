from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from faultline import schemas
from made_places import PLACES
from faultline.schemas import LOCATIONS
from faultline.session import CHECKPOINT_CONF, shared_dir
from faultline.sources import tables

CSV = '''feeder_canonical,latitude,longitude,service_radius_km,confidence,setting,anchor
SAMONDA,7.25,3.5,2.5,high,urban,"place ""Samonda"", north"
APATA,,,,unlocated,,"nothing, found"
ROM,7.1,3.5,1.0,low,rural,"two
lines, ""quoted"""
'''


def months(spark, rows):
    return spark.createDataFrame(rows, "v int, source_month string")


def test_locations_with_quotes_and_commas(spark, tmp_path):
    (tmp_path / "l.csv").write_text(CSV)
    rows = tables.read_locations(spark, str(tmp_path / "l.csv")).collect()
    assert rows[0].anchor == 'place "Samonda", north' and rows[0].latitude == 7.25
    assert (rows[1].latitude, rows[1].setting, rows[1].anchor) == (None, None, "nothing, found")
    assert len(rows) == 3 and rows[2].anchor == 'two\nlines, "quoted"' 


def test_write_checked_counts_and_reads_back(spark, tmp_path):
    df = months(spark, [(i, "MAY" if i % 2 else "JUNE") for i in range(10)])
    assert tables.write_checked(spark, df, str(tmp_path / "t"), "source_month") == 10
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {
        "source_month=JUNE", "source_month=MAY",
    }


def test_one_month_can_be_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(months(spark, [(1, "MAY"), (2, "JUNE")]), path, "source_month")
    tables.write_table(months(spark, [(3, "MAY")]), path, "source_month", replace_only_written=True)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [2, 3]
    tables.write_table(months(spark, [(4, "MAY")]), path, "source_month")
    assert [r.v for r in spark.read.parquet(path).collect()] == [4]


def test_partition_values_are_not_guessed(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    tables.write_table(months(spark, [(1, "2021"), (2, "05")]), path, "source_month")
    df = tables.read_table_or_fail(spark, path, months(spark, [(1, "x")]).schema)
    assert {r.source_month for r in df.collect()} == {"2021", "05"}
    plan = plan_of(df.filter("source_month = '05' AND v > 1").select("v"))
    assert "PartitionFilters: [isnotnull(source_month" in plan
    assert "PushedFilters: [IsNotNull(v), GreaterThan(v,1)]" in plan
    assert "ReadSchema: struct<v:int>" in plan


def test_empty_table_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    months(spark, []).write.parquet(path)
    with pytest.raises(FileNotFoundError):
        tables.read_table_or_fail(spark, path, months(spark, []).schema)


def test_single_file(spark, tmp_path):
    df = spark.range(100).repartition(4).groupBy((F.col("id") % 7).alias("k")).count()
    tables.write_table(df, str(tmp_path / "t"), single_file=True)
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 1


def test_union_matches_by_name(spark):
    a, b = months(spark, [(1, "MAY")]), months(spark, [(2, "JUNE")]).select("source_month", "v")
    assert [r.v for r in tables.union_frames([a, b, a]).collect()] == [1, 2, 1]


class FakeSession:
    """Just the settings a session carries."""

    def __init__(self, master, folder):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = {CHECKPOINT_CONF: folder} if folder else {}


def test_shared_folder_is_the_one_the_session_names():
    cluster = FakeSession("yarn", "hdfs:///shared")
    first, second = shared_dir(cluster, "x"), shared_dir(cluster, "x")
    assert first != second and first.startswith("hdfs:///shared/x-")
    with pytest.raises(RuntimeError):
        shared_dir(FakeSession("yarn", None), "x")
    assert shared_dir(FakeSession("local[2]", None), "x").startswith("/tmp/run-")


def test_location_constants_fit_the_schema(spark):
    assert spark.createDataFrame(PLACES, LOCATIONS).count() == 18
    assert schemas.SILVER.names[-1] == "source_month" and len(schemas.SILVER) == 27


def test_streamed_partition_texts_keep_their_zeros(spark, tmp_path):
    from faultline.streaming.ingest import ingest_parquet

    source, target, log = (str(tmp_path / x) for x in ("in", "out", "log"))
    rows = spark.createDataFrame([(1, "007"), (2, "012")], "v int, code string")
    rows.write.parquet(source)
    got = ingest_parquet(spark, source, rows.schema, target, log, partition_by="code")
    assert sorted((r.v, r.code) for r in got.collect()) == [(1, "007"), (2, "012")]


def test_gathered_rows_are_rebalanced_not_pinned(spark, tmp_path, plan_of):
    df = spark.range(0, 4000, 1, 8).selectExpr("cast(id as int) AS v", "'MAY' AS source_month")
    plan = plan_of(tables.gathered(df, "source_month"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    path = str(tmp_path / "t")
    assert tables.write_checked(spark, tables.gathered(df, "source_month"), path, "source_month") == 4000
    assert len(list((tmp_path / "t" / "source_month=MAY").glob("*.parquet"))) == 1
