"""Typed appends, replacement, drops and SQL text."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from rankloom.schemas import ANALYTICS, COUNTRY_DIM, DATETIME_DIM, STATUS
from rankloom.sinks import conform, run_sql, run_sql_file


def statuses(spark, *rows):
    return spark.createDataFrame(rows, STATUS)


def test_conform_orders_casts_and_pads(spark):
    df = spark.createDataFrame([("N", 4)], "country string, country_id int")
    assert conform(df, COUNTRY_DIM).dtypes == [("country_id", "bigint"), ("country", "string")]
    padded = conform(spark.createDataFrame([(1,)], "date_id int"), DATETIME_DIM).first()
    assert padded.date_id == 1 and padded.hour is None


def test_conform_refuses_what_does_not_fit(spark):
    with pytest.raises(ValueError, match="surplus"):
        conform(spark.createDataFrame([(1, 2)], "country_id int, surplus int"), COUNTRY_DIM)
    with pytest.raises(PySparkException):
        conform(spark.createDataFrame([("x",)], "country_id string"), COUNTRY_DIM).collect()


def test_append_is_a_bag_union(spark, warehouse):
    for _ in range(2):
        warehouse.append("status_log", statuses(spark, ("success", 1.0)))
    assert warehouse.read("status_log").count() == 2


def test_append_unseen_is_a_set_union(spark, warehouse):
    rows = [("success", 1.0), (None, 2.0), ("failed", None), ("success", 1.0)]
    for _ in range(2):
        warehouse.append_unseen("status_log", statuses(spark, *rows))
    assert warehouse.read("status_log").count() == 3


def test_loads_count_once_committed(spark, warehouse):
    def facts(*players):
        return spark.createDataFrame([(p,) for p in players], "player_id int")

    warehouse.write_load("rankings", facts(1, 2), 1)
    warehouse.write_load("rankings", facts(3), 5)
    assert warehouse.read("rankings").count() == 0
    warehouse.commit(5)
    assert [r.player_id for r in warehouse.read("rankings").collect()] == [3]
    warehouse.commit(1)
    assert sorted(r.player_id for r in warehouse.read("rankings").collect()) == [1, 2, 3]


def test_replace_swaps_whole_versions(spark, warehouse):
    def mart(*players):
        return spark.createDataFrame([(p,) for p in players], "player_id bigint")

    def shown():
        return sorted(r.player_id for r in warehouse.read("analytics").collect())

    warehouse.replace("analytics", mart(1, 2))
    reader = warehouse.read("analytics")
    warehouse.replace("analytics", mart(3))
    assert shown() == [3]
    assert reader.count() == 2, "who reads the version before still can"
    warehouse.replace("analytics", warehouse.read("analytics").selectExpr("player_id + 1 AS player_id"))
    assert shown() == [4]
    assert len(warehouse._versions("analytics")) == 2
    assert warehouse.read("analytics").columns == ANALYTICS.names


def test_replace_takes_the_place_of_a_plain_table(spark, warehouse):
    warehouse.append("analytics", spark.createDataFrame([(1,)], "player_id bigint"))
    warehouse.replace("analytics", spark.createDataFrame([(2,)], "player_id bigint"))
    assert [r.player_id for r in warehouse.read("analytics").collect()] == [2]


def test_drop(spark, warehouse):
    warehouse.append("status_log", statuses(spark, ("success", 1.0)))
    warehouse.replace("analytics", spark.createDataFrame([(2,)], "player_id bigint"))
    warehouse.drop(["status_log", "analytics", "rankings"])
    assert not warehouse.exists("status_log") and not warehouse.exists("analytics")
    assert spark.catalog.listTables(warehouse.database) == []


def test_sql_files(spark, warehouse, tmp_path):
    warehouse.append("status_log", statuses(spark, ("success", 1.0), ("failed", 2.0)))
    static, bound, dropping = (tmp_path / f"{n}.sql" for n in ("static", "bound", "dropping"))
    static.write_text(f"SELECT count(*) AS n FROM {warehouse.name('status_log')};")
    bound.write_text("SELECT * FROM IDENTIFIER(:t) WHERE timestamp > :parameter")
    dropping.write_text("DROP TABLE IDENTIFIER(:t);")
    table = {"t": warehouse.name("status_log")}
    assert run_sql_file(spark, str(static)).first().n == 2
    rows = run_sql_file(spark, str(bound), {**table, "parameter": 1.5}).collect()
    assert [r.status for r in rows] == ["failed"]
    run_sql_file(spark, str(dropping), table)
    assert not warehouse.exists("status_log")


def test_sql_values_stay_values(spark):
    df = spark.createDataFrame([("a",), ("b",)], "s string")
    nasty = "a' OR '1' = '1"
    assert run_sql(spark, "SELECT * FROM {df} WHERE s = :v", {"v": nasty}, df=df).count() == 0
    with pytest.raises(PySparkException):
        run_sql(spark, "DROP TABLE IF EXISTS IDENTIFIER(:t)", {"t": "a; DROP TABLE b"})
