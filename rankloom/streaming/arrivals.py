"""Loads of deliveries whose files arrive in a landing folder.

A delivery is a folder of files, and complete once a marker file is there or in a
folder above it, below the landing folder. All deliveries that are complete are loaded
together, as if one after another in the order of their names; batches only say which
there are, so a bound on their files changes the work and never the result.
A feed that keeps one file name must land each delivery in a folder of its own
(`run=2024-12-27/rankings.csv`). Files that come after the marker are no part of it.

Folders seen, and deliveries loaded, are stored tables. What is not loaded yet is found
by an anti-join; only that comes to the driver, which looks for the markers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from rankloom.plans.load import load_deliveries
from rankloom.schemas import DELIVERIES
from rankloom.sinks.warehouse import Warehouse
from rankloom.staging import marked

# Fixed value: the file that Spark writes last.
MARKER = "_SUCCESS"


def arriving_lines(
    spark: SparkSession, folder: str, file_name: str, files_per_batch: int | None = None
) -> DataFrame:
    """Lines of the files under `folder` called `file_name` (a glob), with their delivery."""
    reader = spark.readStream.format("text").option("pathGlobFilter", file_name)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("recursiveFileLookup", True).load(folder).select(
        "value",
        _folder(),
        F.lit(file_name).alias("file_name"),
        F.lit(folder).alias("landing"),
    )


def _folder() -> Column:
    return F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("delivery")


def waiting(warehouse: Warehouse) -> DataFrame:
    """Folders seen that are not loaded yet."""
    return warehouse.read("arrivals").distinct().join(
        warehouse.read("deliveries"), ["delivery", "file_name"], "left_anti"
    )


def _load_complete(warehouse: Warehouse, date_patterns: Sequence[str], marker: str | None) -> None:
    """One load of all that is complete, for each name of files."""
    spark = warehouse.spark
    complete: dict[str, list[str]] = {}
    for row in waiting(warehouse).collect():
        if marker is None or marked(spark, row.delivery, row.landing, marker):
            complete.setdefault(row.file_name, []).append(row.delivery)
    for file_name, folders in sorted(complete.items()):
        lines = spark.read.option("pathGlobFilter", file_name).text(sorted(set(folders)))
        lines = lines.select("value", _folder())
        loaded = spark.createDataFrame([(f, file_name) for f in sorted(set(folders))], DELIVERIES)
        load_deliveries(warehouse, lines, loaded, date_patterns)


def load_arrivals(
    lines: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    date_patterns: Sequence[str] = (),
    marker: str | None = MARKER,
) -> StreamingQuery:
    """Load the deliveries that are complete and not loaded yet, then stop.

    Those still being written wait for a later run. Deliveries are noted as loaded by
    the commit of their load, so one taken up again after a failure is loaded once.
    `marker=None` takes every folder for complete.
    """
    _load_complete(warehouse, date_patterns, marker)

    def load(batch: DataFrame, batch_id: int) -> None:
        store = warehouse.on(batch.sparkSession)
        name = f"arrivals {checkpoint} {batch_id}"
        if not store.committed(name):
            key = store.new_load()
            seen = batch.select("delivery", "file_name", "landing").distinct()
            store.write_load("arrivals", seen, key)
            store.commit(key, name)
        _load_complete(store, date_patterns, marker)

    return (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
