"""The wide table: the star joined back together."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators.best import best_per_group
from rankloom.plans.star import Star
from rankloom.schemas import ANALYTICS, BUCKET, DATE_DIM, LOAD, MART_PARTS, RANKINGS
from rankloom.sinks.warehouse import Warehouse
from rankloom.staging import stage


def _first_of_each(dimension: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest by the other columns."""
    others = [F.col(c).asc_nulls_first() for c in dimension.columns if c != key]
    return best_per_group(dimension, [key], others)


def analytics(star: Star) -> DataFrame:
    """One row per player and date: the numerically largest rank.

    Of the joined rows the one to keep is decided by the facts alone, as long as
    facts without a country or date are out first; versions of a dimension row
    only break the last ties. So the facts go through the shuffle with their own
    columns, one row per player and date at most, and are widened after it: no
    join meets a player or country that fills a third of the feed.
    """
    order = [
        F.col("rank").desc_nulls_last(),
        F.col("points").desc_nulls_last(),
        F.col("rating").desc_nulls_last(),
        F.col("difference").desc_nulls_last(),
        F.col("trend").asc_nulls_first(),
        F.col("country_id").asc_nulls_first(),
    ]
    known = star.rankings.join(star.country_dim, "country_id", "left_semi").join(
        star.date_dim, "date_id", "left_semi"
    )
    best = best_per_group(known, ["player_id", "date_id"], order)
    return (
        best.join(_first_of_each(star.player_dim, "player_id"), "player_id")
        .join(_first_of_each(star.date_dim, "date_id"), "date_id")
        .join(_first_of_each(star.country_dim, "country_id"), "country_id")
        .select(*ANALYTICS.names)
    )


def analytics_distinct(star: Star) -> DataFrame:
    """Every distinct joined row.

    Dimensions hold distinct rows, and the mart has all columns of all four tables, so
    distinct facts join to distinct rows. Duplicates go while rows are narrow, and
    the largest dimension is joined first.
    """
    return (
        star.rankings.distinct()
        .join(star.player_dim, "player_id")
        .join(star.country_dim, "country_id")
        .join(star.date_dim, "date_id")
        .select(*ANALYTICS.names)
    )


def replace_analytics(warehouse: Warehouse, distinct: bool = False) -> None:
    """Rebuild the stored mart from the whole stored star."""
    star = Star(*[warehouse.read(name) for name in Star._fields])
    warehouse.replace("analytics", analytics_distinct(star) if distinct else analytics(star))


def mart_of_loads(warehouse: Warehouse, loads: list[int], distinct: bool = False) -> DataFrame:
    """The mart's rows of these loads, with their `facts_key`.

    A date's facts come in with the date, in one load, so the best of a player and date is
    found in the partitions of its load. Dimensions are read whole.
    """
    dates = warehouse.stored("date_dim").where(F.col(LOAD).isin(loads))
    facts = warehouse.stored("rankings").where(F.col(LOAD).isin(loads))
    star = Star(
        warehouse.read("player_dim"),
        warehouse.read("country_dim"),
        dates.select(*DATE_DIM.names),
        facts.select(*RANKINGS.names),
    )
    rows = analytics_distinct(star) if distinct else analytics(star)
    return rows.join(dates.select("date_id", F.col(LOAD).alias("facts_key")), "date_id")


def _changed(warehouse: Warehouse, table: str, key: str, loads: list[int], distinct: bool) -> DataFrame:
    """Keys whose rows of earlier loads are joined otherwise since these loads."""
    rows = warehouse.stored(table)
    new = rows.where(F.col(LOAD).isin(loads))
    # At most BUCKETS rows.
    buckets = [r[BUCKET] for r in new.select(BUCKET).distinct().collect()]
    rows = rows.where(F.col(BUCKET).isin(buckets)).join(new.select(key).distinct(), key, "left_semi")
    old = rows.where(~F.col(LOAD).isin(loads))
    if distinct:
        return old.select(key).distinct()
    columns = [c for c in rows.columns if c not in (LOAD, BUCKET)]
    first, before = (_first_of_each(r.select(*columns), key) for r in (rows, old))
    others = [c for c in columns if c != key]
    before = before.select(key, *[F.col(c).alias(f"_{c}") for c in others])
    differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in others])
    return first.join(before, key).where(differs).select(key)


def refresh_analytics(warehouse: Warehouse, distinct: bool = False) -> int:
    """Bring the stored mart up to the committed loads; returns how many were (re)computed.

    Those are the loads since the last refresh, and earlier ones with a player or country
    whose dimension rows have changed in a way that shows. The rows go to partitions of
    their own, and one file then puts them in the place of any before, for all readers.
    A mart of the other kind (`distinct`) is recomputed as a whole.
    """
    kind = "distinct" if distinct else "best"
    parts = warehouse.read("mart_parts")
    newest = parts.agg(
        F.max("refresh_key").alias("refresh"), F.max_by("kind", "refresh_key").alias("kind")
    ).first()
    refresh = (newest.refresh or 0) + 1
    loads = warehouse.read("commits").where("has_facts").select(F.col(LOAD).alias("facts_key"))
    if newest.kind == kind:
        # What came since: at most one load a day of the calendar, mostly one.
        since = loads.join(parts, "facts_key", "left_anti")
        keys = [r.facts_key for r in since.collect()]
        if not keys:
            return 0
        mart = warehouse.read("analytics")
        for table, key in (("player_dim", "player_id"), ("country_dim", "country_id")):
            changed = stage(_changed(warehouse, table, key, keys, distinct), "changed")
            if not changed.isEmpty():
                touched = mart.join(changed, key, "left_semi").select("date_id").distinct()
                dates = warehouse.stored("date_dim").join(touched, "date_id", "left_semi")
                keys += [r[LOAD] for r in dates.select(LOAD).distinct().collect()]
    else:
        keys = [r.facts_key for r in loads.collect()]
    keys = sorted(set(keys))
    spark = warehouse.spark
    told = spark.createDataFrame([(key, refresh, kind) for key in keys], MART_PARTS)
    warehouse.write_refresh(mart_of_loads(warehouse, keys, distinct), told, refresh)
    return len(keys)
