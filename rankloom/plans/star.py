"""The star schema of one feed, without stored tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from rankloom.operators.dimensions import country_dim, date_dim, player_dim
from rankloom.operators.facts import rankings
from rankloom.staging import stage


class Star(NamedTuple):
    player_dim: DataFrame
    country_dim: DataFrame
    date_dim: DataFrame
    rankings: DataFrame


def build_star(rows: DataFrame, distinct_facts: bool = True) -> Star:
    """Four tables from filled rows.

    The rows are staged, as four consumers read them and each needs other
    columns. Dates and countries are staged too: their written size lets the
    planner broadcast them to the fact rows when they are small.
    """
    rows = stage(rows, "rows")
    dates = stage(date_dim(rows), "dates")
    return Star(
        player_dim(rows),
        stage(country_dim(rows), "countries"),
        dates,
        rankings(rows, dates, distinct_facts),
    )
