import random
import uuid

import pytest
from pyspark.sql import functions as F

from faultline.operators import quality
from faultline.operators.quality import Constraint
from faultline.sources import catalog

SCHEMA = "k int, v string, x double"
RULES = [
    Constraint("key", "k IS NOT NULL"),
    Constraint("known", "v IN ('a', 'b')"),
    Constraint("positive", "x > 0", fails=False),
]


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_report_counts_nulls_as_violations(spark, plan_of):
    df = rows(spark, (1, "a", 1.0), (None, "b", -1.0), (2, None, None), (3, "c", 0.0))
    report = quality.constraint_report(df, RULES)
    assert sorted(map(tuple, report.collect())) == [
        ("key", "fail", 1, 4), ("known", "fail", 2, 4), ("positive", "warn", 3, 4),
    ]
    assert plan_of(report).split("== Initial Plan ==")[0].count("Scan ") == 1
    assert {r.violations for r in quality.constraint_report(df.limit(0), RULES).collect()} == {0}


def test_a_write_is_judged_in_its_own_pass(spark, tmp_path):
    df, seen = quality.observed(rows(spark, (1, "a", 1.0), (2, "b", -1.0)), RULES)
    df.write.parquet(str(tmp_path / "t"))
    assert quality.judged(seen, RULES) == {"positive": 1}
    df, seen = quality.observed(rows(spark, (None, "z", 1.0)), RULES)
    df.write.parquet(str(tmp_path / "u"))
    with pytest.raises(quality.ViolatedError, match="key: 1 rows, known: 1 rows"):
        quality.judged(seen, RULES)


def covered(whole, *parts):
    return tuple(quality.cover(whole, list(parts)).first())


def test_cover(spark):
    dice = random.Random(3)
    data = [(dice.choice([None, 1, 2]), dice.choice(["a", None]), dice.choice([0.5, None])) for _ in range(60)]
    whole = rows(spark, *data)
    assert covered(whole, rows(spark, *data[40:]), rows(spark, *data[:40][::-1])) == (60, 60, True)
    assert covered(whole, rows(spark, *data[1:])) == (60, 59, False)
    assert covered(whole, rows(spark, *data, data[0])) == (60, 61, False)
    assert covered(rows(spark, (1, "a", 2.0), (2, "b", 3.0)), rows(spark, (2, "a", 2.0), (1, "b", 3.0))) == (2, 2, False)
    # a null is not the value beside it, and repeated rows count
    pair = "x string, y string"
    one, two = spark.createDataFrame([("a", None)], pair), spark.createDataFrame([(None, "a")], pair)
    assert covered(one, two) == (1, 1, False)
    assert covered(one.union(one).union(two), two.union(two).union(one)) == (3, 3, False)
    assert covered(whole.limit(0), whole.limit(0)) == (0, 0, True)


@pytest.fixture
def database(spark):
    name = f"scratch_{uuid.uuid4().hex}"
    quoted = "`" + name.replace("`", "``") + "`"
    spark.sql(f"CREATE DATABASE {quoted}")
    yield name
    spark.sql(f"DROP DATABASE {quoted} CASCADE")


def test_publishing_is_one_step(spark, database, tmp_path):
    table = "`" + database.replace("`", "``") + "`.t"
    month = ("month", "MAY")
    df = spark.createDataFrame([(1,), (2,)], "k int").withColumn("month", F.lit("MAY"))
    rules = [Constraint("small", "k < 10"), Constraint("one", "k = 1", fails=False)]
    (tmp_path / "table").mkdir()
    catalog.create_parquet_table(spark, database, "t", df.schema, str(tmp_path / "table"), "month")

    def publish(*values):
        new = spark.createDataFrame([(v,) for v in values], "k int").withColumn("month", F.lit("MAY"))
        return catalog.publish_partition(spark, new, database, "t", month, str(tmp_path / "parts"), rules)

    def read():
        return sorted(r.k for r in spark.table(table).filter("month = 'MAY'").collect())

    assert publish(1, 2) == {"one": 1} and read() == [1, 2]
    before = catalog.partition_folder(spark, database, "t", month)
    with pytest.raises(quality.ViolatedError):
        publish(3, 11)
    assert read() == [1, 2] and catalog.partition_folder(spark, database, "t", month) == before
    reader = spark.read.parquet(before)  # has begun before the switch
    assert publish(5) == {"one": 1} and read() == [5]
    assert sorted(r.k for r in reader.collect()) == [1, 2]
    assert catalog.partition_folder(spark, database, "t", month) != before
