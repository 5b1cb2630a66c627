"""JSON text per line, fields taken by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.schemas import FEED
from rankloom.sources.lines import without_headers


def json_records(lines: DataFrame) -> DataFrame:
    """Each line as a JSON object of strings, in column `record`.

    The line is cut at every comma, quoted or not. A field the line lacks is
    left out of its object; surplus fields are ignored.
    """
    cells = without_headers(lines).select(F.split("value", ",").alias("cell"))
    fields = [F.get("cell", F.lit(i)).alias(name) for i, name in enumerate(FEED.names)]
    return cells.select(F.to_json(F.struct(*fields)).alias("record"))
