"""Every registered query equals its SQL in another engine: names, types, all values."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from martloom.plans.catalogue import catalogue
from tests.compare import duckdb_over, duckdb_result, spark_result
from tests.conftest import SF_DIR
from tests.dirty import damaged_copy


@pytest.fixture(scope="module")
def damaged(tmp_path_factory):
    return damaged_copy("/root/testdata/sf0.001", tmp_path_factory.mktemp("damaged"), seed=11)


def assert_same(spark, name: str, sf_dir: str) -> None:
    types, rows = spark_result(driver.queries()[name](spark, sf_dir))
    with duckdb_over(sf_dir) as con:
        expected_types, expected_rows = duckdb_result(con, driver.oracle_sql()[name])
    assert types == expected_types
    assert rows == expected_rows


def test_every_query_has_sql():
    """Those that learn, search or tokenize aside; they come and go with their package."""
    assert set(catalogue()) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert_same(spark, name, SF_DIR)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql_on_damaged_tables(spark, damaged, name):
    """With no broadcast, so that every join runs as it does between big tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert_same(spark, name, damaged)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() == 1383
