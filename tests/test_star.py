"""Dimensions, facts and what is new, on small frames."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from samples import FIRST_DAY, SECOND_DAY

from rankloom import operators as ops
from rankloom import plans, sources
from rankloom.functions import coerce_date
from rankloom.schemas import COUNTRY_DIM, DATE_DIM, PLAYER_DIM, RANKINGS
from rankloom.staging import stage


@pytest.fixture
def sample(spark):
    frame = spark.createDataFrame([(line,) for line in FIRST_DAY + SECOND_DAY], "value string")
    return ops.fill_defaults(sources.accepted(sources.decode_lines(frame)))


def test_sample_star(sample):
    star = plans.build_star(sample)
    assert star.player_dim.count() == 15
    assert star.country_dim.count() == 9
    assert [tuple(r) for r in star.date_dim.orderBy("date_id").collect()] == [
        (1, date(2024, 12, 26), "Thursday", 12, 2024),
        (2, date(2024, 12, 27), "Friday", 12, 2024),
    ]
    assert star.rankings.count() == 30
    assert ops.player_dim(sample, with_image=True).count() == 18
    assert plans.analytics(star).count() == 30


def test_defaults_fill_three_columns_only(feed_of):
    row = ops.fill_defaults(feed_of({"id": 1})).first()
    assert (row.difference, row.trend, row.faceImageId) == (0.0, "Flat", "0")
    assert (row.rank, row.name, row.country, row.updated_on) == (None, None, None, None)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-12-27", date(2024, 12, 27)),
        ("2024-12-27 10:30:00", date(2024, 12, 27)),
        (" 2024-12-27 ", date(2024, 12, 27)),
        ("2024-02-30", None),
        ("2024-12-27 soon", None),
        ("20241227", None),
        ("27/12/2024", None),
        ("1677-09-21", None),
        ("1677-09-22", date(1677, 9, 22)),
        ("2262-04-11", date(2262, 4, 11)),
        ("2262-04-12", None),
        ("", None),
        (None, None),
    ],
)
def test_dates_are_coerced(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(coerce_date(F.col("t"))).first()[0] == expected


def test_date_patterns_are_tried_in_turn(spark):
    frame = spark.createDataFrame([("27/12/2024",), ("12.27.2024",), ("nothing",)], "t string")
    read = coerce_date(F.col("t"), ["dd/MM/yyyy", "MM.dd.yyyy"])
    assert [r[0] for r in frame.select(read).collect()] == [date(2024, 12, 27)] * 2 + [None]


def test_rows_without_a_date_match_the_day_without_a_date(feed_of):
    rows = ops.fill_defaults(
        feed_of(
            {"id": 1, "lastUpdatedOn": "2024-12-27"},
            {"id": 2, "lastUpdatedOn": "never"},
            {"id": 3},
        )
    )
    dates = ops.date_dim(rows)
    assert [(r.date_id, r.date) for r in dates.orderBy("date_id").collect()] == [
        (1, date(2024, 12, 27)),
        (2, None),
    ]
    facts = ops.rankings(rows, dates)
    assert sorted((r.player_id, r.date_id) for r in facts.collect()) == [(1, 1), (2, 2), (3, 2)]


def test_new_rows_and_dates(spark, feed_of):
    known = spark.createDataFrame(
        [(4, date(2024, 12, 26), "Thursday", 12, 2024), (7, None, None, None, None)], DATE_DIM
    )
    rows = ops.fill_defaults(
        feed_of(
            {"id": 1, "lastUpdatedOn": "2024-12-26"},
            {"id": 2, "lastUpdatedOn": "2024-12-28"},
            {"id": 3, "lastUpdatedOn": "2024-12-28"},
            {"id": 4, "lastUpdatedOn": "2024-12-25"},
            {"id": 5, "lastUpdatedOn": "unknown"},
        )
    )
    # A row without a date is always new, its date is not: the calendar has one NULL day.
    assert sorted(r.id for r in ops.only_new(rows, known).collect()) == [2, 3, 4, 5]
    fresh = ops.new_dates(rows, known).orderBy("date_id").collect()
    assert [(r.date_id, r.date) for r in fresh] == [
        (8, date(2024, 12, 25)),
        (9, date(2024, 12, 28)),
    ]


def test_numbers_are_consecutive_over_many_ranges(spark):
    start = datetime(2024, 1, 1)
    stamps = [start + timedelta(seconds=random.Random(5).randrange(10**9) + i) for i in range(4000)]
    stamps = sorted(set(stamps))
    shuffled = random.Random(6).sample(stamps, len(stamps))
    frame = spark.createDataFrame([(s,) for s in shuffled + stamps[:50]], "ts timestamp_ntz")
    got = ops.datetime_dim(frame, "ts", start=10).orderBy("date_id").collect()
    assert [(r.date_id, r.date) for r in got] == list(enumerate(stamps, 11))
    assert [r.hour for r in got] == [s.hour for s in stamps]


def test_tagged_records_come_back_whole(sample):
    star = plans.build_star(sample)
    tagged = ops.tag_records({"date": star.date_dim, "player": star.player_dim})
    assert {r["type"]: r["count"] for r in tagged.groupBy("type").count().collect()} == {
        "date": 2,
        "player": 15,
    }
    back = ops.records_of(tagged, "date", DATE_DIM)
    assert sorted(back.collect()) == sorted(star.date_dim.collect())


def test_rows_are_tagged_in_one_pass(spark, feed_of):
    filled = ops.fill_defaults(
        feed_of(
            *[{"id": 1, "name": "A B", "lastUpdatedOn": "2024-12-26", "difference": 0.0}] * 3,
            {"id": 1, "name": "A B", "lastUpdatedOn": "2024-12-26", "difference": -0.0},
            {"id": 2, "name": None, "lastUpdatedOn": "never", "countryId": 4, "country": "C"},
        )
    )
    rows = stage(filled, "rows")
    dates = stage(ops.date_dim(rows), "dates")
    tagged = ops.tag_rows(rows, dates)
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2
    star = plans.build_star(filled)
    stored = ops.stage_tagged(tagged)
    for kind, table, schema in (
        ("player", star.player_dim, PLAYER_DIM),
        ("country", star.country_dim, COUNTRY_DIM),
        ("date", star.date_dim, DATE_DIM),
        ("ranking", star.rankings, RANKINGS),
    ):
        back = ops.records_of(stored, kind, schema)
        assert Counter(back.collect()) == Counter(table.collect())
        read = back._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(type#" in read and f"= {kind})]" in read
    nothing = ops.tag_rows(rows.limit(0), dates)
    assert nothing.isEmpty()


def test_profile(sample):
    row = ops.profile(sample, "updated_on").first()
    assert (row.n_rows, row.n_columns, row.updated_on_distinct, row.difference_filled) == (
        30,
        11,
        2,
        30,
    )
