"""Every registered query against its SQL."""

import pytest
from oracle import compare, duck

from faultline.plans.inputs import TABLES, table
from faultline.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", sorted(TABLES))
def test_stated_schema_is_the_stored_one(spark, name):
    stored = spark.read.parquet(f"{SF}/{name}.parquet").schema
    assert table(spark, SF, name).schema == stored


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
