"""A bitmap of keys, of a fixed size, that lets most rows pass by a join.

A row whose bit is not set has no partner. A row whose bit is set may have one, and
goes through the join as before, so a full bitmap costs time and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 2^26 bits are 8 MiB, whatever the number of keys.
ROWS, ROW_BITS = 1 << 11, 1 << 15


def sieve_of(keys: DataFrame, column: str) -> Broadcast:
    """The bitmap of a bigint column. At most `ROWS` rows of 4 KiB come to the driver."""
    key = F.col(column)
    row = F.pmod(key, F.lit(ROWS))
    bit = F.pmod(F.shiftright(key, 11), F.lit(ROW_BITS))
    packed = keys.groupBy(row.alias("row")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    bits = np.zeros((ROWS, ROW_BITS // 8), np.uint8)
    for found in packed.collect():
        bits[found.row] = np.frombuffer(found.bits, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bits)


def hits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys have their bit set."""
    row, bit = keys & (ROWS - 1), (keys >> 11) & (ROW_BITS - 1)
    return (bits[row, bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def sifted(rows: DataFrame, column: str, sieve: Broadcast, inside: bool) -> DataFrame:
    """Rows whose key may be in the sieve, or those whose key is not."""
    at = rows.columns.index(column)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = hits(sieve.value, batch.column(at).to_numpy())
            yield batch.filter(pa.array(found == inside))

    return rows.mapInArrow(sift, rows.schema)
