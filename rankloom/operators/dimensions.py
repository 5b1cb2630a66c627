"""The three dimensions, each the distinct rows of a few feed columns.

`distinct` aggregates inside every map task first, so a player, country or date
that fills a third of the feed reaches the shuffle once per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rankloom.functions.dates import calendar_fields
from rankloom.functions.names import first_name, last_name
from rankloom.operators.numbering import number_rows
from rankloom.schemas import DATE_DIM, DATETIME_DIM


def player_columns(with_image: bool = False) -> list[Column]:
    columns = [
        F.col("id").alias("player_id"),
        first_name(F.col("name")).alias("first_name"),
        last_name(F.col("name")).alias("last_name"),
    ]
    if with_image:
        columns.append(F.col("faceImageId").alias("face_image_id"))
    return columns


def player_dim(rows: DataFrame, with_image: bool = False) -> DataFrame:
    """One row per distinct player; the image id, where asked for, parts versions."""
    return rows.select(*player_columns(with_image)).distinct()


def country_columns() -> list[Column]:
    return [F.col("countryId").alias("country_id"), F.col("country")]


def country_dim(rows: DataFrame) -> DataFrame:
    return rows.select(*country_columns()).distinct()


def date_dim(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The distinct days of `updated_on`, numbered by day after the `known` ones.

    The window has no partitioning: it sorts days, not rows, and there are at
    most `functions.dates.CALENDAR_DAYS` of them.
    """
    days = rows.select(F.col("updated_on").alias("date")).distinct()
    number = F.row_number().over(Window.orderBy(F.col("date").asc_nulls_last())).cast("bigint")
    if known is not None:
        number = number + F.coalesce(known.agg(F.max("date_id")).scalar(), F.lit(0))
    return days.select(
        number.alias("date_id"),
        "date",
        *[c.alias(name) for name, c in calendar_fields(F.col("date")).items()],
    ).select(*DATE_DIM.names)


def datetime_dim(rows: DataFrame, column: str, start: int = 0) -> DataFrame:
    """The calendar of a feed stamped by time: one row per distinct timestamp."""
    stamps = rows.select(F.col(column).cast("timestamp_ntz").alias("date")).distinct()
    stamp = F.col("date")
    return (
        number_rows(stamps, "date", "date_id", start)
        .withColumns({"hour": F.hour(stamp), **calendar_fields(stamp)})
        .select(*DATETIME_DIM.names)
    )
