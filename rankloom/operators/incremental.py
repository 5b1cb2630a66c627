"""What a feed holds beyond the dates that are loaded already."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators.dimensions import date_dim, datetime_dim


def only_new(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose date is not in `known`. A row without a date is always new."""
    loaded = known.select(F.col("date").alias("_loaded"))
    return rows.join(loaded, F.col("updated_on") == F.col("_loaded"), "left_anti")


def first_brought(rows: DataFrame, order: str) -> DataFrame:
    """Rows of the first of several deliveries that has their date; those without one all.

    As if the deliveries were loaded one after another, in the order of their names: what
    a later one says of a date already loaded brings nothing in.
    """
    first = rows.where("updated_on IS NOT NULL").groupBy(F.col("updated_on").alias("_day"))
    first = first.agg(F.min(order).alias("_first"))
    located = rows.join(first, F.col("updated_on") == F.col("_day"), "left")
    kept = F.col("_first").isNull() | (F.col(order) == F.col("_first"))
    return located.where(kept).drop("_day", "_first")


def _unknown(rows: DataFrame, known: DataFrame) -> DataFrame:
    """The distinct dates of `rows` that `known` lacks; NULL is a date like others here."""
    loaded = known.select(F.col("date").alias("_loaded"))
    dates = rows.select("updated_on").distinct()
    return dates.join(loaded, F.col("updated_on").eqNullSafe(F.col("_loaded")), "left_anti")


def new_dates(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Calendar rows for the dates not in `known`, numbered after them."""
    return date_dim(_unknown(rows, known), known)


def new_datetimes(rows: DataFrame, known: DataFrame, last: DataFrame) -> DataFrame:
    """Calendar rows for the timestamps not in `known`, numbered after the highest key in `last`.

    `known` need only hold the days of `rows`.
    """
    start = last.agg(F.max("date_id").alias("id")).first().id or 0
    return datetime_dim(_unknown(rows, known), "updated_on", start)
