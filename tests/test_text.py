import datetime as dt

import pytest
from pyspark.sql import functions as F

from faultline.functions import text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def s(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize(
    "raw, expected",
    [(" 3.5 ", 3.5), ("1,200", None), ("1.5d", 1.5), ("nan", None), (None, None), ("-7", -7.0)],
)
def test_to_double(spark, raw, expected):
    assert one(spark, text.to_double(s(raw))) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [("12", 12), ("12.0", 12), (" 3.5 ", 3), ("nan", None), ("x", None), ("3000000000", None)],
)
def test_to_int(spark, raw, expected):
    assert one(spark, text.to_int(s(raw))) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2021-01-05 00:00:00", dt.date(2021, 1, 5)),
        ("1900-01-07 00:00:00", dt.date(1900, 1, 7)),
        ("2021", dt.date(2021, 1, 1)),
        ("2021-3", dt.date(2021, 3, 1)),
        ("2021-01-05 junk", dt.date(2021, 1, 5)),
        ("2021-01-05x", None),
        ("33kV FEEDERS OUTAGES", None),
        ("05/01/2021", None),
        ("nan", None),
        (None, None),
    ],
)
def test_to_date(spark, raw, expected):
    assert one(spark, text.to_date(s(raw))) == expected


@pytest.mark.parametrize(
    "clock, expected",
    [
        ("14:30:00", dt.datetime(2021, 1, 5, 14, 30)),
        ("9:05", dt.datetime(2021, 1, 5, 9, 5)),
        ("nan", None),
        ("24:00:00", None),
        ("1900-01-01 00:00:00", None),
        (None, None),
    ],
)
def test_event_time(spark, clock, expected):
    day = F.lit("2021-01-05").cast("date")
    assert one(spark, text.to_event_time(day, s(clock))) == expected


def test_event_time_needs_a_date(spark):
    assert one(spark, text.to_event_time(F.lit(None).cast("date"), s("14:30:00"))) is None


def test_epoch_seconds_ignore_the_time_zone(spark):
    ts = F.lit("2021-03-28 02:30:00.9").cast("timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert one(spark, text.epoch_seconds(ts)) == 1616898600
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("raw", ["", "nan", "NaN", "NA", "N/A", "None", "null", "#N/A", "<NA>"])
def test_missing_value_texts_are_null(spark, raw):
    assert one(spark, text.null_tokens(s(raw))) is None


def test_other_texts_stay(spark):
    assert one(spark, text.null_tokens(s("NAN "))) == "NAN "


@pytest.mark.parametrize(
    "name, month",
    [
        ("REGION JANUARY 2021.xlsx", "JANUARY"),
        ("september.xlsx", "SEPTEMBER"),
        ("Septem_2021.xlsx", "SEPTEM_2021"),
        ("data.xlsx", "UNKNOWN"),
    ],
)
def test_month_from_name(spark, name, month):
    assert one(spark, text.month_from_name(s(name))) == month


def test_strip_takes_unicode_spaces(spark):
    assert one(spark, text.strip(s(" \t a b \x1f\n"))) == "a b"
