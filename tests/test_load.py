"""Incremental load: two days, repetition, and loads that break off."""

from __future__ import annotations

import json
import re
from collections import Counter
from pathlib import Path

import pytest
from samples import FIRST_DAY, HEADER, SECOND_DAY

from rankloom import plans, sources
from rankloom.schemas import PLAYER_DIM
from rankloom.sinks import Warehouse
from rankloom.staging import shared_root

STAR = ("player_dim", "country_dim", "date_dim", "rankings")


def lines_of(spark, lines):
    return spark.createDataFrame([(line,) for line in [HEADER, *lines]], "value string")


def contents(warehouse):
    return {name: sorted(map(repr, warehouse.read(name).collect())) for name in STAR}


def sizes(warehouse):
    return {name: warehouse.read(name).count() for name in STAR}


def test_tables_that_do_not_exist_read_as_empty(warehouse):
    assert sizes(warehouse) == dict.fromkeys(STAR, 0)


def test_a_timed_load_reads_the_months_it_touches(spark, warehouse, feed_of):
    def load(*stamps):
        rows = feed_of(*[{"id": i, "lastUpdatedOn": s} for i, s in enumerate(stamps)])
        return plans.load_rows(warehouse, rows, timed=True)

    first = [f"2024-{m:02d}-03 0{h}:00:00" for m in range(1, 10) for h in range(3)]
    assert load(*first, "no date") == 27
    second = ["2024-03-03 01:00:00", "2024-03-03 07:00:00", "1999-12-31 23:59:59"] * 2
    assert load(*second) == 2
    assert load(*first, *second) == 0
    calendar = warehouse.read("datetime_dim").orderBy("date_id").collect()
    assert [r.date_id for r in calendar] == list(range(1, 30))
    expected = [*sorted(first), "1999-12-31 23:59:59", "2024-03-03 07:00:00"]
    assert [str(r.date) for r in calendar] == expected
    facts = Counter(r.date_id for r in warehouse.read("rankings").collect())
    assert facts == Counter([*range(1, 28), 28, 28, 29, 29])

    days = spark.createDataFrame([(calendar[6].date,), (None,)], "d timestamp_ntz")
    march = warehouse.read_months("datetime_dim", days)
    assert march.count() == 4
    plan = march._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*month_key", plan)
    assert warehouse.read_months("datetime_dim", days.limit(0)).isEmpty()
    warehouse.drop(["datetime_dim"])
    assert load(*second) == 3


def test_two_days_then_the_second_again(spark, warehouse):
    assert plans.load_lines(warehouse, lines_of(spark, FIRST_DAY)) == 1
    assert plans.load_lines(warehouse, lines_of(spark, SECOND_DAY)) == 1
    assert sizes(warehouse) == dict(zip(STAR, (15, 9, 2, 30), strict=True))
    plans.refresh_analytics(warehouse)
    assert warehouse.read("analytics").count() == 30
    before = contents(warehouse)
    assert plans.load_lines(warehouse, lines_of(spark, SECOND_DAY)) == 0
    assert contents(warehouse) == before


def test_day_by_day_equals_all_at_once(spark, warehouse, tmp_path):
    other = Warehouse(spark, f"{warehouse.database}_other", str(tmp_path / "other"))
    for day in (FIRST_DAY, SECOND_DAY):
        plans.load_lines(warehouse, lines_of(spark, day))
    plans.load_lines(other, lines_of(spark, FIRST_DAY + SECOND_DAY))
    assert contents(warehouse) == contents(other)


def test_rows_of_a_loaded_date_bring_nothing_in(spark, warehouse):
    plans.load_lines(warehouse, lines_of(spark, FIRST_DAY))
    late = "99,16,New Player,Nepal,500,500,2024-12-26,Up,1,77,1.0"
    assert plans.load_lines(warehouse, lines_of(spark, [late, *SECOND_DAY])) == 1
    assert sizes(warehouse) == dict(zip(STAR, (15, 9, 2, 30), strict=True))


def test_a_new_version_of_a_dimension_row_is_added(spark, warehouse):
    plans.load_lines(warehouse, lines_of(spark, FIRST_DAY))
    renamed = [line.replace("Ada Korhan", "Ada Maria Korhan") for line in SECOND_DAY]
    plans.load_lines(warehouse, lines_of(spark, renamed))
    assert warehouse.read("player_dim").where("player_id = 501").count() == 2
    plans.refresh_analytics(warehouse)
    assert warehouse.read("analytics").count() == 30
    plans.refresh_analytics(warehouse, distinct=True)
    assert warehouse.read("analytics").count() == 32


BREAKS = ("rejected_lines", "player_dim", "country_dim", "rankings", "date_dim", "commits")


@pytest.mark.parametrize(
    ("table", "retried"),
    [*[(table, FIRST_DAY) for table in BREAKS], ("date_dim", FIRST_DAY + SECOND_DAY), ("date_dim", SECOND_DAY)],
)
def test_a_load_that_breaks_off_changes_nothing(spark, warehouse, monkeypatch, table, retried):
    """It breaks after a table is written, before the manifest is; the next may hold other files."""
    old = [line.replace("2024-12-26", "2024-12-20") for line in FIRST_DAY]
    plans.load_lines(warehouse, lines_of(spark, old))
    before = contents(warehouse)
    insert = Warehouse._insert

    def failing(self, name, *given):
        if name == table == "commits":
            raise OSError("lost")
        insert(self, name, *given)
        if name == table:
            raise OSError("lost")

    monkeypatch.setattr(Warehouse, "_insert", failing)
    renamed = [line.replace("Ada", "Eva") for line in FIRST_DAY]
    with pytest.raises(OSError):
        plans.load_lines(warehouse, lines_of(spark, [*renamed, "x,1,Ann"]))
    monkeypatch.undo()
    assert contents(warehouse) == before
    assert warehouse.read("rejected_lines").count() == 0

    plans.load_lines(warehouse, lines_of(spark, retried))
    days = 1 + len(retried) // 15
    assert sizes(warehouse) == dict(zip(STAR, (15, 9, days, 15 + len(retried)), strict=True))
    after = contents(warehouse)
    warehouse.sweep()
    assert contents(warehouse) == after
    left = spark.table(warehouse.name("player_dim")).where("first_name = 'Eva'")
    assert left.count() == 0, "what broke off is swept away"


def test_undecodable_lines_are_kept_by_load(spark, warehouse):
    lines = lines_of(spark, [*FIRST_DAY, "1,2,3,4,5,6,7,8,9,10,11,12", "x,1,Ann", "x,1,Ann"])

    def kept():
        return Counter(tuple(r) for r in warehouse.read("rejected_lines").collect())

    once = Counter({("1,2,3,4,5,6,7,8,9,10,11,12", "too many fields"): 1, ("x,1,Ann", "not a number"): 2})
    for _ in range(2):
        plans.load_lines(warehouse, lines, delivery="run=1")
    assert kept() == once
    plans.load_lines(warehouse, lines)
    assert kept() == once + once


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unseen_dimension_rows_read_few_buckets(spark, warehouse):
    plans.load_lines(warehouse, lines_of(spark, FIRST_DAY))
    few = spark.createDataFrame([(501, "Ada", "Korhan"), (501, "Eva", "Korhan")], PLAYER_DIM)
    unseen = warehouse.unseen("player_dim", few)
    assert [r.first_name for r in unseen.collect()] == ["Eva"]
    filters = re.findall(r"PartitionFilters: \[([^]]*)\]", plan_of(unseen))
    assert any(re.search(r"bucket#\d+L? = \d+", f) for f in filters)


def test_the_mart_is_brought_up_by_loads(spark, warehouse, tmp_path):
    other = Warehouse(spark, f"{warehouse.database}_whole", str(tmp_path / "whole"))
    days = [FIRST_DAY, SECOND_DAY, [line.replace("2024-12-26", "2024-12-30") for line in FIRST_DAY]]
    days[2] = [line.replace("Ada Korhan", "Aaa Korhan").replace("Ostia", "Astia") for line in days[2]]
    for distinct in (False, True):
        for n, day in enumerate(days):
            plans.load_lines(warehouse, lines_of(spark, day))
            plans.load_lines(other, lines_of(spark, day))
            done = plans.refresh_analytics(warehouse, distinct)
            assert done == (3 if distinct and n == 0 else 0 if distinct else (1, 1, 3)[n])
            plans.replace_analytics(other, distinct)
            shown = sorted(map(repr, warehouse.read("analytics").collect()))
            assert shown == sorted(map(repr, other.read("analytics").collect()))
        assert plans.refresh_analytics(warehouse, distinct) == 0
    warehouse.sweep()
    assert sorted(map(repr, warehouse.read("analytics").collect())) == shown


def test_a_refresh_reads_the_facts_of_new_loads_only(spark, warehouse):
    for day in (FIRST_DAY, SECOND_DAY):
        plans.load_lines(warehouse, lines_of(spark, day))
    keys = [r.load_key for r in warehouse.read("commits").where("has_facts").collect()]
    plan = plan_of(plans.mart_of_loads(warehouse, keys[1:]))
    filters = re.findall(r"PartitionFilters: \[([^]]*)\]", plan)
    assert any(f"= {keys[1]}" in f for f in filters)
    assert not any(str(keys[0]) in f for f in filters)


def test_other_date_forms(spark, warehouse):
    lines = [line.replace("2024-12-27", "27/12/2024") for line in SECOND_DAY]
    plans.load_lines(warehouse, lines_of(spark, FIRST_DAY))
    assert plans.load_lines(warehouse, lines_of(spark, lines), ["dd/MM/yyyy"]) == 1
    assert [str(r.date) for r in warehouse.read("date_dim").orderBy("date_id").collect()] == [
        "2024-12-26",
        "2024-12-27",
    ]


def test_a_payload_lands_and_loads(spark, warehouse, tmp_path):
    records = [dict(zip(HEADER.split(","), line.split(","), strict=True)) for line in FIRST_DAY]
    for record in records:
        difference = record.pop("difference")
        if difference:
            record["difference"] = float(difference)
        record["id"] = record.pop("id")  # keys in another order than the lines' columns
    (tmp_path / "payload.json").write_text(json.dumps({"rank": records}))
    documents = sources.read_payload(spark, str(tmp_path / "payload.json"))
    plans.land_payload(documents, str(tmp_path / "landed"))
    assert plans.load_lines(warehouse, sources.read_lines(spark, str(tmp_path / "landed"))) == 1
    other = Warehouse(spark, f"{warehouse.database}_lines", str(tmp_path / "lines"))
    plans.load_lines(other, lines_of(spark, FIRST_DAY))
    assert contents(warehouse) == contents(other)


def test_a_load_leaves_no_staged_tables(spark, warehouse):
    folder = Path(shared_root(spark))
    before = set(folder.iterdir())
    plans.load_lines(warehouse, lines_of(spark, FIRST_DAY))
    assert set(folder.iterdir()) == before
