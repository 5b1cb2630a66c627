"""SQL text from files: as it is, with values, or with table names."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from rankloom.staging import read_whole


def run_sql(
    spark: SparkSession, text: str, args: dict[str, Any] | None = None, **frames: DataFrame
) -> DataFrame:
    """Run `text`.

    `:name` markers are bound to `args` as typed values, never as text, so no
    value can change the statement. A table name is such a value too, inside
    `IDENTIFIER(:name)`. `{name}` stands for a DataFrame of `frames`.
    """
    return spark.sql(text, args=args, **frames)


def run_sql_file(
    spark: SparkSession, path: str, args: dict[str, Any] | None = None, **frames: DataFrame
) -> DataFrame:
    """`run_sql` of a file, from any store Spark reaches."""
    return run_sql(spark, read_whole(spark, path), args, **frames)
