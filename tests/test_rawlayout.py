import pytest
from pyspark.sql import functions as F

from faultline.operators import rawlayout

ROWS = [
    ("a", i, ["Event No" if i == 2 else str(i)]) for i in range(40)
] + [("b", i, [" Event No " if i in (0, 5) else str(i), None]) for i in range(7)]


def grid(spark, extra=()):
    return spark.createDataFrame([*ROWS, *extra], "source_file string, row_idx int, cells array<string>")


@pytest.mark.parametrize("chunk", [100_000, 3])
def test_rows_after_header(spark, monkeypatch, chunk):
    monkeypatch.setattr(rawlayout, "CHUNK_ROWS", chunk)
    got = rawlayout.rows_after_header(grid(spark), rawlayout.has_cell("cells"))
    assert sorted((r.source_file, r.row_idx) for r in got.collect()) == [
        *[("a", i) for i in range(3, 40)], *[("b", i) for i in range(1, 7)],
    ]


def test_long_file_is_spread(spark, monkeypatch):
    monkeypatch.setattr(rawlayout, "CHUNK_ROWS", 3)
    got = rawlayout.rows_after_header(grid(spark), rawlayout.has_cell("cells"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "__chunk" in plan


def test_missing_header(spark):
    late = [("c", i, ["Event No" if i == 10 else "x"]) for i in range(12)]
    marker = rawlayout.has_cell("cells")
    with pytest.raises(Exception, match="no header row in c"):
        rawlayout.rows_after_header(grid(spark, late), marker).collect()
    kept = rawlayout.rows_after_header(grid(spark, late), marker, on_missing="report")
    assert {r.source_file for r in kept.collect()} == {"a", "b"}
    missing = rawlayout.files_without_header(grid(spark, late), marker)
    assert [r.source_file for r in missing.collect()] == ["c"]


def test_named_cells(spark):
    df = spark.createDataFrame([(["1", "nan", "x", "cut"],), (["2"],)], "cells array<string>")
    rows = df.select(*rawlayout.named_cells("cells", ("a", "b", "c"))).collect()
    assert [tuple(r) for r in rows] == [("1", None, "x"), ("2", None, None)]


def test_load_summary(spark):
    df = spark.createDataFrame([("MAY",), ("MAY",), ("JUNE",)], "source_month string")
    assert tuple(rawlayout.load_summary(df).first()) == (3, 2)


def test_provenance_takes_the_base_name(spark):
    path = F.lit("s3://bucket/raw/a b JANUARY.xlsx")
    row = spark.range(1).select(*rawlayout.provenance(path, F.lit("now"))).first()
    assert tuple(row) == ("a b JANUARY.xlsx", "now", "JANUARY")
