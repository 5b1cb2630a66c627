from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs_of(spark):
    """Documents from (id, text) or (id, text, source), with a few columns more of clashing names."""

    def build(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        frame = spark.createDataFrame(full, DOCS)
        return frame.selectExpr("*", "1 AS kept", "'x' AS _row", "2 AS n_words", "3 AS k", "4 AS slot")

    return build
