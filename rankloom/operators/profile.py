"""Shape and completeness of a frame, in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(rows: DataFrame, distinct_of: str) -> DataFrame:
    """One row: row and column counts, filled cells by column, distinct values of one."""
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(rows.columns)).alias("n_columns"),
        *[F.count(name).alias(f"{name}_filled") for name in rows.columns],
        F.count_distinct(distinct_of).alias(f"{distinct_of}_distinct"),
    )


def column_profile(rows: DataFrame) -> DataFrame:
    """One row per column: position, name, type and filled cells."""
    counts = rows.agg(*[F.count(name).alias(name) for name in rows.columns])
    described = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("dtype"),
            F.col(name).alias("filled"),
        )
        for position, (name, kind) in enumerate(rows.dtypes)
    ]
    return counts.select(F.inline(F.array(*described)))
