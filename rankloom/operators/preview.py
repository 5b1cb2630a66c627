"""A look at a table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def preview(rows: DataFrame, count: int = 10, *order_by: str) -> DataFrame:
    """A few rows: the first ones by `order_by`, any where no order is given."""
    return (rows.orderBy(*order_by) if order_by else rows).limit(count)
