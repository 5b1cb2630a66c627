"""The mart against a brute-force reading of its definition."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pytest

from rankloom import plans
from rankloom.schemas import ANALYTICS, COUNTRY_DIM, DATE_DIM, PLAYER_DIM, RANKINGS


def low(value):
    return (value is not None, value if value is not None else 0)


def brute_join(players, countries, dates, facts):
    return [
        (*fact, first, last, country, day, name, month, year)
        for fact in facts
        for player, first, last in players
        if player == fact[0]
        for key, country in countries
        if key == fact[1]
        for date_id, day, name, month, year in dates
        if date_id == fact[2]
    ]


def brute_best(joined):
    def order(row):
        _, country_id, _, rank, rating, points, difference, trend, first, last, country, day = row[:12]
        descending = [low(v) for v in (rank, points, rating, difference)]
        negated = [(not filled, -v) for filled, v in descending]
        return (negated, (trend is not None, trend or ""), country_id, country, day, first, last)

    best = {}
    for row in joined:
        group = (row[0], row[2])
        if group not in best or order(row) < order(best[group]):
            best[group] = row
    return list(best.values())


def random_star(seed):
    """Few keys, many ties, doubled dimension rows, and facts whose keys lead nowhere."""
    rng = random.Random(seed)
    players = [(p, rng.choice("AB"), rng.choice("XYZ")) for p in range(6) for _ in range(2)]
    countries = [(c, rng.choice(["N", "S"])) for c in range(4) for _ in range(2)]
    start = date(2024, 1, 1)
    days = [(i, start + timedelta(days=i)) for i in range(1, 6)]
    dates = [(i, d, d.strftime("%A"), d.month, d.year) for i, d in days]
    facts = [
        (
            0 if rng.random() < 0.34 else rng.randrange(8),
            rng.randrange(6),
            rng.randrange(1, 8),
            rng.choice([None, 1, 2]),
            rng.choice([700, 800]),
            rng.choice([700, 800]),
            rng.choice([0.0, 1.0]),
            rng.choice(["Up", "Down", "Flat"]),
        )
        for _ in range(400)
    ]
    return sorted(set(players)), sorted(set(countries)), dates, facts


@pytest.mark.parametrize("seed", range(3))
def test_mart_equals_brute_force(spark, seed):
    parts = random_star(seed)
    schemas = (PLAYER_DIM, COUNTRY_DIM, DATE_DIM, RANKINGS)
    frames = [spark.createDataFrame(rows, schema) for rows, schema in zip(parts, schemas, strict=True)]
    star = plans.Star(*frames)
    joined = brute_join(*parts)
    best = plans.analytics(star)
    assert best.columns == ANALYTICS.names
    assert Counter(map(tuple, best.collect())) == Counter(brute_best(joined))
    distinct = plans.analytics_distinct(star)
    assert Counter(map(tuple, distinct.collect())) == Counter(set(joined))


def test_largest_rank_is_kept(spark):
    facts = [(1, 1, 1, rank, 5, 5, 0.0, "Up") for rank in (3, 9, 7, 9)]
    star = plans.Star(
        spark.createDataFrame([(1, "A", "B")], PLAYER_DIM),
        spark.createDataFrame([(1, "N")], COUNTRY_DIM),
        spark.createDataFrame([(1, date(2024, 1, 1), "Monday", 1, 2024)], DATE_DIM),
        spark.createDataFrame(facts, RANKINGS),
    )
    assert [r["rank"] for r in plans.analytics(star).collect()] == [9]
    assert plans.analytics_distinct(star).count() == 3
