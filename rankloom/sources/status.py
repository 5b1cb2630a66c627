"""Job status messages: JSON text, base64 on the wire."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import parse_once
from rankloom.schemas import STATUS


def encode_status(status: Column, timestamp: Column) -> Column:
    body = F.to_json(F.struct(status.alias("status"), timestamp.alias("timestamp")))
    return F.base64(F.encode(body, "UTF-8"))


def mark_status(messages: DataFrame, column: str = "value", encoded: bool = True) -> DataFrame:
    """`status` and `timestamp`, and for messages without a status their text and the reason."""
    body = F.col(column)
    if encoded:
        body = F.try_to_binary(body, F.lit("base64")).cast("string")
    bodies = messages.select(F.col(column).alias("raw_line"), body.alias("_body"))
    parsed = bodies.select("raw_line", "_body", parse_once(F.from_json("_body", STATUS)))
    reason = (
        F.when(F.col("_body").isNull(), "not base64" if encoded else "no text")
        .when(F.try_parse_json("_body").isNull(), "no JSON")
        .when(F.col("status").isNull(), "no status")
    )
    return parsed.select(
        "status",
        "timestamp",
        F.when(reason.isNotNull(), F.col("raw_line")).alias("raw_line"),
        reason.alias("reject_reason"),
    )


def decode_status(messages: DataFrame, column: str = "value", encoded: bool = True) -> DataFrame:
    """`status` and `timestamp`; an absent key or unreadable message gives NULL."""
    return mark_status(messages, column, encoded).select("status", "timestamp")


def rejected_status(
    messages: DataFrame, column: str = "value", encoded: bool = True
) -> DataFrame:
    """Messages without a status, as text with the reason."""
    marked = mark_status(messages, column, encoded).where(F.col("reject_reason").isNotNull())
    return marked.select("raw_line", "reject_reason")
