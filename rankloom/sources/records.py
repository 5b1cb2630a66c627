"""Records of CSV files whose quoted fields hold line breaks, cut in parallel.

A line break parts records if the quotes before it in its file are even in number. Only
lines with an odd number of quotes change that: each line gets the number of odd ones before it
in its split as it is read, and the splits before are added up, one row a split. Lines of
one record are joined where they are read. No file is read whole by one task, as the
reader's own `multiLine` does, and no line is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rankloom.functions.text import count_of
from rankloom.sources.runs import SPLIT, joined_rows, scan, sum_of_splits_before, with_sums_before
from rankloom.staging import stage


def _odd(line: Column) -> Column:
    return count_of(line, '"') % 2 == 1


def has_odd_lines(spark: SparkSession, path: str) -> bool:
    """Whether a line of the files has an odd number of quotes."""
    return not spark.read.text(path).where(_odd(F.col("value"))).isEmpty()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, in `value`, with `is_header` and `is_open`.

    A file's first record is its header. The last quote of a file whose quotes are odd in
    number opens no field: its line is a record of its own, `is_open`, and so are those
    after it. Line breaks inside fields stay as they are; a carriage return at a
    record's end goes.
    """
    # Only this break parts lines, so that any other in a field is kept as it is.
    lines = scan(spark, path, "\n").withColumn("odd", _odd(F.col("value")).cast("int"))
    lines = stage(with_sums_before(lines, "odd"), "csv-lines")
    of_file = Window.partitionBy("file")
    splits = lines.groupBy(*SPLIT).agg(F.sum("odd").alias("_odd"), F.min("place").alias("_first"))
    splits = splits.select(
        *SPLIT,
        "_first",
        sum_of_splits_before(F.col("_odd")).alias("_before"),
        F.sum("_odd").over(of_file).alias("_all"),
        F.min("split").over(of_file).alias("_start"),
    )
    first = (F.col("split") == F.col("_start")) & (F.col("place") == F.col("_first"))
    lines = lines.join(stage(splits, "csv-splits"), SPLIT).select(
        *SPLIT,
        "place",
        "value",
        (F.col("odd") == 1).alias("odd"),
        "_all",
        first.alias("leads"),
        (F.col("_before") + F.col("odd_before")).alias("_passed"),
    )
    # An odd line without a partner: the last of a file that has an odd number of them.
    lone = (F.col("_all") % 2 == 1) & (F.col("_passed") >= F.col("_all") - 1)
    within = F.col("_passed") % 2 == 1
    inside = (within | F.col("odd")) & ~lone
    single = lines.where(~inside).select(
        "value", F.col("leads").alias("is_header"), (F.col("odd") & lone).alias("is_open")
    )
    several = lines.where(inside).withColumns(
        {"starts": F.col("odd") & ~within, "ends": F.col("odd") & within}
    )
    joined = joined_rows(several, "\n").select(
        "value", F.col("leads").alias("is_header"), F.lit(False).alias("is_open")
    )
    return single.unionByName(joined).withColumn("value", F.regexp_replace("value", "\r$", ""))
