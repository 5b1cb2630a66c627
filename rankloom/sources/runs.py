"""Rows of a text scan in their order: sums along a split, and records of several rows.

A task reads the rows of a split one after another, so sums run along with the scan and
rows that follow each other are joined where they are read. No row is sorted or dealt
out for that: a task holds one batch and its sums, however many rows a split has. Only
records that a batch ends in are put together by a shuffle, at most two parts a batch.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rankloom.staging import stage

# Workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT = ["file", "split"]
_RUN = (
    "file string, split bigint, place bigint, value string,"
    " leads boolean, starts boolean, ends boolean"
)

Batches = Iterator[pa.RecordBatch]


def scan(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Rows of text with their file, the offset of their split, and their order inside it."""
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _parted(batch: pa.RecordBatch) -> np.ndarray:
    """Whether a row is the first of the batch or of another split than the row before."""
    parted = np.ones(batch.num_rows, bool)
    parted[1:] = False
    for name in SPLIT:
        column = batch.column(name)
        other = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
        parted[1:] |= other.to_numpy(zero_copy_only=False)
    return parted


def _summing(columns: tuple[str, ...]) -> Callable[[Batches], Batches]:
    def summed(batches: Batches) -> Batches:
        last, carried = None, dict.fromkeys(columns, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            parted = _parted(batch)
            starts, of = np.flatnonzero(parted), np.cumsum(parted) - 1
            key = [batch.column(name)[0].as_py() for name in SPLIT]
            sums = []
            for name in columns:
                values = _numbers(batch, name)
                before = np.cumsum(values) - values
                before -= before[starts][of]
                if key == last:
                    before[of == 0] += carried[name]
                carried[name] = before[-1] + values[-1]
                sums.append(pa.array(before, pa.int64()))
            last = [batch.column(name)[-1].as_py() for name in SPLIT]
            names = [*batch.schema.names, *[f"{name}_before" for name in columns]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums], names=names)

    return summed


def with_sums_before(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows of a `scan` with the sums of whole numbers over the rows before in their split."""
    longs = [F.col(c).cast("bigint").alias(c) if c in columns else F.col(c) for c in rows.columns]
    rows = rows.select(*longs)
    sums = [T.StructField(f"{name}_before", T.LongType()) for name in columns]
    return rows.mapInArrow(_summing(columns), T.StructType([*rows.schema.fields, *sums]))


def sum_of_splits_before(column: Column) -> Column:
    """Over one row a split: the sum of a column over the splits before in the file."""
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0))


def _joining(separator: str) -> Callable[[Batches], Batches]:
    def joined(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            place = _numbers(batch, "place")
            first = _parted(batch)
            first[1:] |= place[1:] != place[:-1] + 1
            first[1:] |= _numbers(batch, "starts")[1:] | _numbers(batch, "ends")[:-1]
            begin = np.flatnonzero(first)
            end = np.append(begin[1:], batch.num_rows)
            value = batch.column("value")
            parts = pa.ListArray.from_arrays(pa.array(np.append(begin, end[-1]), pa.int32()), value)
            kept = batch.take(pa.array(begin))
            kept = kept.set_column(3, "value", pc.binary_join(parts, pa.scalar(separator, value.type)))
            yield kept.set_column(6, "ends", batch.column("ends").take(pa.array(end - 1)))

    return joined


def joined_rows(rows: DataFrame, separator: str) -> DataFrame:
    """One row per record, with `file`, its text in `value`, and whether its first row `leads`.

    `rows` are those of a `scan` that are part of a record; of each, one row `starts` it and
    one `ends` it. Rows may stand in any order: only neighbours by `place` are joined at once.
    """
    rows = rows.select(*SPLIT, "place", "value", "leads", "starts", "ends")
    runs = stage(rows.mapInArrow(_joining(separator), _RUN), "runs")
    whole = F.col("starts") & F.col("ends")
    parts = runs.where(~whole).withColumn("ends", F.col("ends").cast("int"))
    sums = parts.groupBy(*SPLIT).agg(F.sum("ends").alias("_sum"))
    sums = stage(sums.select(*SPLIT, sum_of_splits_before(F.col("_sum")).alias("_ended")), "run-splits")
    upto = Window.partitionBy(*SPLIT).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.col("_ended") + F.coalesce(F.sum("ends").over(upto), F.lit(0))
    pieces = F.sort_array(F.collect_list(F.struct("split", "place", "value")))
    met = parts.join(sums, SPLIT).withColumn("_record", ended).groupBy("file", "_record").agg(
        F.array_join(F.transform(pieces, lambda p: p["value"]), separator).alias("value"),
        F.bool_or("leads").alias("leads"),
    )
    columns = ["file", "value", "leads"]
    return runs.where(whole).select(*columns).unionByName(met.select(*columns))
