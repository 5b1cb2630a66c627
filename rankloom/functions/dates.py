"""Dates that never raise: what cannot be read becomes NULL."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whole days a 64-bit nanosecond timestamp can hold. Feeds are
# read under that limit, and it is what bounds a calendar of distinct days:
# at most CALENDAR_DAYS rows and one for NULL, however large the feed.
EARLIEST = date(1677, 9, 22)
LATEST = date(2262, 4, 11)
CALENDAR_DAYS = (LATEST - EARLIEST).days + 1


def coerce_timestamp(text: Column, patterns: Sequence[str] = ()) -> Column:
    """ISO text first, then each of `patterns`; NULL outside the limit."""
    readings = [text.try_cast("timestamp_ntz")]
    readings += [F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in patterns]
    stamp = F.coalesce(*readings)
    return F.when(stamp.cast("date").between(F.lit(EARLIEST), F.lit(LATEST)), stamp)


def coerce_date(text: Column, patterns: Sequence[str] = ()) -> Column:
    return coerce_timestamp(text, patterns).cast("date")


def month_key(day: Column) -> Column:
    """Months since year 0, 0 for no day: at most some 7,000 values by the range of dates."""
    return F.coalesce(F.year(day) * 12 + F.month(day), F.lit(0)).cast("bigint")


def calendar_fields(day: Column) -> dict[str, Column]:
    """The attributes a calendar row carries besides its key."""
    return {
        "day_of_week": F.date_format(day, "EEEE"),
        "month": F.month(day),
        "year": F.year(day),
    }


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def epoch_seconds(stamp: Column) -> Column:
    """Seconds since 1970 of a zoneless timestamp, whatever zone the session is in."""
    whole = F.unix_date(stamp.cast("date")) * F.lit(86400).cast("bigint")
    whole = whole + F.hour(stamp) * 3600 + F.minute(stamp) * 60
    micros = (F.extract(F.lit("SECOND"), stamp) * 1000000).cast("bigint")
    return (whole * 1000000 + micros) / F.lit(1e6)
