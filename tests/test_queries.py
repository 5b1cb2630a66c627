"""Every registered query against its SQL, rows and types, on the given tables."""

from __future__ import annotations

import os

import pytest
from comparing import kinds_of_spark, kinds_of_sql, plan_of, rows_of_spark, rows_of_sql, tables_of

import __spark_entry__ as entry_point
from rankloom.catalog.feed import spread
from rankloom.catalog.oracle import ORACLE
from rankloom.catalog.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Plans that pair all rows with all rows, or hand rows to Python.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow")



@pytest.fixture(scope="module")
def connection():
    return tables_of(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    assert kinds_of_spark(df) == kinds_of_sql(connection, ORACLE[name])
    assert rows_of_spark(df) == rows_of_sql(connection, ORACLE[name])
    plan = plan_of(df)
    assert not [word for word in UNWANTED if word in plan]


@pytest.mark.parametrize("name", ["date_hour", "status_gate", "coerce_dates", "datetime_fact"])
def test_results_do_not_depend_on_the_session_zone(spark, connection, name):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert rows_of_spark(QUERIES[name](spark, SF_DIR)) == rows_of_sql(connection, ORACLE[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_queries_leave_no_databases(spark):
    before = {d.name for d in spark.catalog.listDatabases()}
    QUERIES["append_sink"](spark, SF_DIR)
    assert {d.name for d in spark.catalog.listDatabases()} == before


def test_only_a_scan_of_few_splits_is_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    wide, narrow = spark.range(0, 100, 1, cores), spark.range(0, 100, 1, 1)
    assert "Exchange" not in plan_of(spread(wide))
    assert "Exchange" in plan_of(spread(narrow))


def test_entry_point(spark):
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql())
    df = entry_point.entry(spark)
    assert df.columns[:3] == ["player_id", "country_id", "date_id"]
    assert df.count() > 0
