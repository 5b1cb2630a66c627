"""File sinks."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import CSV_OPTIONS
from rankloom.schemas import FEED

# Workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_feed_csv(rows: DataFrame, path: str) -> None:
    """Landing CSV with header; columns are put in contract order by name."""
    rows.select(*FEED.names).write.options(header=True, **CSV_OPTIONS).csv(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Column `value` as text, one row per line."""
    lines.select("value").write.text(path)


def write_json_records(records: DataFrame, path: str) -> None:
    """Column `record`, JSON text already, as JSON lines."""
    write_lines(records.select(F.col("record").alias("value")), path)


def _as_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lead = '{"rank": ['
    for batch in batches:
        for part in (batch.slice(0, 1), batch.slice(1)):
            if part.num_rows:
                value = part.column("value")
                lines = pc.binary_join_element_wise(pa.scalar(lead, value.type), value, "")
                yield pa.RecordBatch.from_arrays([lines], names=["value"])
                lead = ", "
    if lead == ", ":
        yield pa.RecordBatch.from_arrays([pa.array(["]}"])], names=["value"])


def write_large_payload(records: DataFrame, path: str) -> None:
    """Column `value`, a record's JSON text, as a document for each task with rows, a file each."""
    write_lines(records.select("value").mapInArrow(_as_documents, "value string"), path)
