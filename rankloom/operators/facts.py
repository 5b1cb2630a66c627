"""The fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.schemas import RANKINGS


def with_date_key(rows: DataFrame, dates: DataFrame) -> DataFrame:
    """Feed rows with the key of their date; rows without a date match the NULL day."""
    keys = dates.select("date_id", F.col("date").alias("_day"))
    return rows.join(keys, F.col("updated_on").eqNullSafe(F.col("_day")), "left").drop("_day")


def ranking_columns() -> list[Column]:
    """The fact columns of rows with `date_id`."""
    named = {"player_id": "id", "country_id": "countryId"}
    return [F.col(named.get(name, name)).alias(name) for name in RANKINGS.names]


def rankings(rows: DataFrame, dates: DataFrame, distinct: bool = True) -> DataFrame:
    """Feed rows with the key of their date; rows without a date match the NULL day.

    `distinct=False` spares the shuffle for a consumer that keeps one row per
    group anyway.
    """
    facts = with_date_key(rows, dates).select(*ranking_columns())
    return facts.distinct() if distinct else facts
