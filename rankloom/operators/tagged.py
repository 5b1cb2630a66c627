"""All four tables' records in one collection, each with the name of its kind."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions.dates import calendar_fields
from rankloom.functions.text import parse_once
from rankloom.operators.dimensions import country_columns, player_columns
from rankloom.operators.facts import ranking_columns, with_date_key
from rankloom.schemas import DATE_DIM
from rankloom.staging import stage


def tag_records(frames: dict[str, DataFrame]) -> DataFrame:
    """Bag union of (`type`, `data`), with `data` the record as JSON text."""
    tagged = [
        df.select(F.lit(kind).alias("type"), F.to_json(F.struct("*")).alias("data"))
        for kind, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, tagged)


def tag_rows(rows: DataFrame, dates: DataFrame) -> DataFrame:
    """The distinct records of the whole star, as `tag_records` has them, in one pass over `rows`.

    `rows` are filled feed rows and `dates` their calendar, of which only the keys are
    read. Each row yields a record of each kind, and one aggregate, which combines in the
    map task, makes them distinct.
    """
    day = F.col("updated_on")
    calendar = {"date": day, **calendar_fields(day), "date_id": F.col("date_id")}
    # A negative zero equals zero, but is another text.
    zero = F.when(F.col("difference") == 0, 0.0).otherwise(F.col("difference"))
    located = with_date_key(rows.withColumn("difference", zero), dates)
    kinds = {
        "player": player_columns(),
        "country": country_columns(),
        "date": [calendar[name].alias(name) for name in DATE_DIM.names],
        "ranking": ranking_columns(),
    }

    def record(kind: str, columns: list[Column]) -> Column:
        return F.struct(F.lit(kind).alias("type"), F.to_json(F.struct(*columns)).alias("data"))

    return located.select(F.inline(F.array(*[record(*kind) for kind in kinds.items()]))).distinct()


def stage_tagged(tagged: DataFrame) -> DataFrame:
    """`tagged` written once, by kind: `records_of` then reads the files of its kind only."""
    return stage(tagged, "tagged", by="type")


def records_of(tagged: DataFrame, kind: str, schema: T.StructType) -> DataFrame:
    """The records of one kind, as columns again."""
    return tagged.where(F.col("type") == kind).select(parse_once(F.from_json("data", schema)))
