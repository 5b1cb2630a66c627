"""Missing values and the parsed update date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.dates import coerce_date, coerce_timestamp
from rankloom.schemas import DEFAULTS


def fill_defaults(
    rows: DataFrame, date_patterns: Sequence[str] = (), keep_time: bool = False
) -> DataFrame:
    """Fill the columns that have a default; `lastUpdatedOn` becomes `updated_on`.

    That is a DATE, or with `keep_time` a timestamp for `datetime_dim`.
    """
    filled = {name: F.coalesce(F.col(name), F.lit(value)) for name, value in DEFAULTS.items()}
    coerce = coerce_timestamp if keep_time else coerce_date
    return rows.withColumns(
        {**filled, "updated_on": coerce(F.col("lastUpdatedOn"), date_patterns)}
    ).drop("lastUpdatedOn")
