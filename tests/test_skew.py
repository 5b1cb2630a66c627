"""Plans under skew: one player, country and date each hold a third of the rows."""

from __future__ import annotations

import re

import pytest
from comparing import plan_of, rows_of_spark, rows_of_sql, tables_of
from pyspark.sql import functions as F

from rankloom.catalog.oracle import ORACLE
from rankloom.catalog.queries import QUERIES

SOURCE = "/root/testdata/sf0.01"

# Joins by shuffle only, and partitions small enough for the hot one to stand out.
SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512b",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512b",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    for name in ("customer", "nation", "events"):
        spark.read.parquet(f"{SOURCE}/{name}.parquet").coalesce(1).write.parquet(
            f"{folder}/written/{name}"
        )
    orders = spark.read.parquet(f"{SOURCE}/orders.parquet")
    hot = F.col("o_orderkey") % 3 == 0
    orders.withColumns(
        {
            "o_custkey": F.when(hot, F.lit(7).cast("bigint")).otherwise(F.col("o_custkey")),
            "o_orderdate": F.when(
                hot, F.lit("1996-05-05").cast("timestamp_ntz")
            ).otherwise(F.col("o_orderdate")),
        }
    ).repartition(8, "o_orderkey").write.parquet(f"{folder}/written/orders")
    return folder


@pytest.fixture
def hot_tables(spark, hot_dir, monkeypatch):
    """The registered queries read the skewed tables; DuckDB does too."""
    from rankloom.catalog import feed

    def table(session, _sf_dir, name):
        return session.read.parquet(f"{hot_dir}/written/{name}")

    monkeypatch.setattr(feed, "table", table)
    connection = tables_of("/nowhere")
    for name in ("orders", "customer", "nation", "events"):
        connection.execute(f"CREATE VIEW {name} AS FROM '{hot_dir}/written/{name}/*.parquet'")
    return connection


@pytest.fixture
def shuffled_joins(spark):
    before = {key: spark.conf.get(key, None) for key in SHUFFLED}
    for key, value in SHUFFLED.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


NAMES = [
    "analytics",
    "analytics_distinct",
    "rankings_fact",
    "player_dim",
    "country_dim",
    "date_dim",
    "incremental_fact",
    "incremental_load",
    "team_performance",
]


@pytest.mark.parametrize("name", NAMES)
def test_results_hold_under_skew(spark, hot_tables, shuffled_joins, name):
    df = QUERIES[name](spark, "unused")
    assert rows_of_spark(df) == rows_of_sql(hot_tables, ORACLE[name])


@pytest.mark.parametrize("name", ["player_dim", "rankings_fact"])
def test_hot_player_is_split(spark, hot_tables, shuffled_joins, name):
    """Also where the aggregate that follows could have kept the join's partitioning."""
    df = QUERIES[name](spark, "unused")
    df.collect()
    assert "SortMergeJoin(skew=true)" in plan_of(df)


@pytest.mark.parametrize("joins", ["broadcast", "shuffled"])
def test_mart_cuts_groups_before_the_shuffle(spark, request, hot_tables, joins):
    if joins == "shuffled":
        request.getfixturevalue("shuffled_joins")
    df = QUERIES["analytics"](spark, "unused")
    df.collect()
    plan = plan_of(df).split("Initial Plan")[0]
    limits = re.findall(r"WindowGroupLimit \[player_id#\d+L?, date_id#\d+L?\].* 1, (\w+)", plan)
    assert limits[:2] == ["Final", "Partial"]
    between = plan[plan.index("1, Final") : plan.index("1, Partial")]
    assert "Exchange hashpartitioning(player_id" in between
