"""Incremental load of a feed into a warehouse.

A date is loaded as a whole or not at all. A load writes partitions of its own in all
tables, and one row of the manifest then lets all of them count: a load that breaks
off, wherever it does, leaves every table as it was. One writer of dates at a time is
assumed, as their keys continue from the last one.

No row vanishes: one whose date is loaded is left out as the feed's rule has it, and
one that cannot be read, or has no readable date, is kept in `rejected_lines`, by load.
A load with a name (its delivery) keeps them once, however often it is taken up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import csv_line
from rankloom.operators.defaults import fill_defaults
from rankloom.operators.dimensions import country_dim, player_dim
from rankloom.operators.facts import rankings
from rankloom.operators.incremental import first_brought, new_dates, new_datetimes, only_new
from rankloom.schemas import FEED
from rankloom.sinks.files import write_feed_csv
from rankloom.sinks.warehouse import Warehouse
from rankloom.sources.lines import decode_lines, rejected
from rankloom.sources.payload import decode_payload, flatten_payload
from rankloom.staging import scratch

UNDATED = "no readable date"


def _load(
    warehouse: Warehouse,
    marked: DataFrame,
    date_patterns: Sequence[str],
    name: str | None = None,
    timed: bool = False,
    deliveries: DataFrame | None = None,
) -> int:
    """Store rows with `raw_line` and `reject_reason`. New ones are parsed and written once.

    With `deliveries`, rows have the `delivery` they came in, and those are noted as loaded.
    """
    calendar = "datetime_dim" if timed else "date_dim"
    rows = fill_defaults(marked, date_patterns, keep_time=timed)
    undated = F.col("reject_reason").isNull() & F.col("updated_on").isNull()
    reason = F.when(undated, UNDATED).otherwise(F.col("reject_reason"))
    rows = rows.withColumn("reject_reason", reason).withColumns(
        {
            "updated_on": F.when(reason.isNull(), F.col("updated_on")),
            "raw_line": F.when(reason.isNotNull(), F.col("raw_line")),
        }
    )
    with scratch(warehouse.spark) as stage:
        if timed:
            # The rows name the months of the calendar to read, which has no bound as a whole.
            rows = stage(rows, "timed")
            known = warehouse.read_months(calendar, rows.select("updated_on"))
        else:
            known = warehouse.read(calendar)
        fresh = stage(only_new(rows, known), "rows")
        if deliveries is not None:
            fresh = first_brought(fresh, "delivery")
        good, rejects = fresh.where("reject_reason IS NULL"), rejected(fresh)
        if timed:
            new = new_datetimes(good, known, warehouse.read("datetime_last"))
        else:
            new = new_dates(good, known)
        dates = stage(new, "dates")
        days = dates.count()
        kept_before = name is not None and warehouse.committed(name)
        keep = not kept_before and not rejects.isEmpty()
        if not (days or keep or deliveries is not None):
            return 0
        load = warehouse.new_load()
        if keep:
            warehouse.write_load("rejected_lines", rejects, load)
        if days:
            for table, dimension in (("player_dim", player_dim), ("country_dim", country_dim)):
                warehouse.write_load(table, warehouse.unseen(table, dimension(good)), load)
            # Sorted inside each file, so that row groups cover few dates.
            facts = rankings(good, dates).sortWithinPartitions("date_id")
            warehouse.write_load("rankings", facts, load)
            warehouse.write_load(calendar, dates, load)
        if deliveries is not None:
            warehouse.write_load("deliveries", deliveries, load)
        warehouse.commit(load, name, has_facts=days > 0)
        return days


def load_rows(
    warehouse: Warehouse,
    rows: DataFrame,
    date_patterns: Sequence[str] = (),
    delivery: str | None = None,
    timed: bool = False,
) -> int:
    """Load typed feed rows; returns how many dates were new.

    `timed` keeps the time of day: the calendar is `datetime_dim`, one row a timestamp.
    """
    marked = rows.select(
        *FEED.names,
        csv_line(*FEED.names).alias("raw_line"),
        F.lit(None).cast("string").alias("reject_reason"),
    )
    return _load(warehouse, marked, date_patterns, delivery, timed)


def load_lines(
    warehouse: Warehouse,
    lines: DataFrame,
    date_patterns: Sequence[str] = (),
    delivery: str | None = None,
) -> int:
    """Load feed lines; those that cannot be read, or have no date, go to `rejected_lines`."""
    return _load(warehouse, decode_lines(lines), date_patterns, delivery)


def load_deliveries(
    warehouse: Warehouse,
    lines: DataFrame,
    deliveries: DataFrame,
    date_patterns: Sequence[str] = (),
) -> int:
    """Load the lines of several deliveries (`value`, `delivery`) as one load.

    The outcome is that of loading them one after another in the order of their names,
    in as many jobs as one of them takes.
    """
    return _load(warehouse, decode_lines(lines, "delivery"), date_patterns, deliveries=deliveries)


def load_payload(
    warehouse: Warehouse,
    texts: DataFrame,
    date_patterns: Sequence[str] = (),
    delivery: str | None = None,
) -> int:
    """Load payload documents without landing them; broken ones go to `rejected_lines`."""
    return _load(warehouse, decode_payload(texts), date_patterns, delivery)


def land_payload(texts: DataFrame, path: str, rejects: Warehouse | None = None) -> None:
    """The records of payload documents as landing CSV; others into the quarantine of `rejects`."""
    write_feed_csv(flatten_payload(texts), path)
    if rejects and not rejects.committed(path):
        load = rejects.new_load()
        rejects.write_load("rejected_lines", rejected(decode_payload(texts)), load)
        rejects.commit(load, path)
