"""Consecutive numbers over a set of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rankloom.staging import stage


def number_rows(rows: DataFrame, order_by: str, number: str, start: int | Column = 0) -> DataFrame:
    """Number `rows` from `start` + 1 in the order of `order_by`, whose values are distinct.

    The rows are range-partitioned, which is even as no value repeats, and
    numbered inside each range; only the sizes of the ranges, one row per
    shuffle partition, are summed up in a single task.
    """
    order = F.col(order_by).asc_nulls_last()
    ranges = stage(
        rows.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_size"))
    offsets = stage(
        sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")),
        "offsets",
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        ranges.withColumn("_inside", inside)
        .join(offsets, "_range")
        .withColumn(number, (first + F.col("_offset") + F.col("_inside")).cast("bigint"))
        .drop("_range", "_offset", "_inside")
    )
