"""Status messages: history, latest state, and the mart refresh they gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from rankloom.plans.mart import refresh_analytics
from rankloom.schemas import REJECTED_LINES, STATUS
from rankloom.sinks.warehouse import Warehouse
from rankloom.sources.status import mark_status
from rankloom.staging import scratch

# Fixed value: the status that lets the mart be rebuilt.
SUCCESS = "success"


def arriving_status(spark: SparkSession, folder: str, encoded: bool = True) -> DataFrame:
    """Messages landed as text, one per line, those without a status marked."""
    return mark_status(spark.readStream.format("text").load(folder), encoded=encoded)


def successes(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("status") == SUCCESS)


def latest_status(history: DataFrame) -> DataFrame:
    """The newest message; the larger status text where two share a time."""
    newest = [F.col("timestamp").desc_nulls_last(), F.col("status").desc_nulls_last()]
    return history.orderBy(*newest).limit(1)


def keep_status(messages: DataFrame, warehouse: Warehouse, checkpoint: str) -> StreamingQuery:
    """Keep every message, by batch, and nothing else."""
    return refresh_on_success(messages, warehouse, checkpoint, refresh=False)


def refresh_on_success(
    messages: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    by_latest: bool = False,
    refresh: bool = True,
) -> StreamingQuery:
    """Keep every message, by batch, and refresh the mart once per batch that calls for it.

    A batch calls for it when it holds a success or, `by_latest`, when the
    newest message ever kept is one. Of each batch the newest message is kept once more,
    in a table of its own, so that the log is not read again. A batch that is replayed
    finds its messages kept.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        store = warehouse.on(batch.sparkSession)
        name = f"status {checkpoint} {batch_id}"
        with scratch(batch.sparkSession) as stage:
            batch = stage(batch, "messages")
            if not store.committed(name):
                key = store.new_load()
                messages = batch.select(*STATUS.names)
                store.write_load("status_log", messages, key)
                store.write_load("status_latest", latest_status(messages), key)
                rejects = batch.where("reject_reason IS NOT NULL")
                store.write_load("rejected_lines", rejects.select(*REJECTED_LINES.names), key)
                store.commit(key, name)
            if not refresh:
                return
            decisive = latest_status(store.read("status_latest")) if by_latest else batch
            if not successes(decisive).isEmpty():
                refresh_analytics(store)

    return (
        messages.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def track_latest_status(messages: DataFrame) -> DataFrame:
    """Streaming aggregate with the newest message as its only row and state."""
    messages = messages.select(*STATUS.names)
    newest = F.max_by("status", F.struct("timestamp", "status")).alias("status")
    return messages.agg(newest, F.max("timestamp").alias("timestamp"))
