"""Ranking payloads: JSON documents that hold one array of records."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.text import is_mistyped, parse_once, typed_once
from rankloom.schemas import FEED
from rankloom.sources.lines import accepted


def read_payload(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Documents from files, as text in `value`: one per file, or one per line.

    A document is one row of one task: for bulk data, write one per line. Files with a
    large document each are cut by `decode_large_payload`.
    """
    return spark.read.text(path, wholetext=one_per_file)


def _records(texts: DataFrame, column: str) -> DataFrame:
    """A `record` per element of `rank`; `text` and `fault` of documents that have no list there."""
    parsed = texts.where(F.col(column).isNotNull()).select(
        F.col(column).alias("text"),
        parse_once(F.struct(F.try_parse_json(column).alias("document"))),
    )
    listed = parsed.select(
        "text",
        parse_once(
            F.struct(
                (F.col("document").isNotNull() & F.col("text").rlike(r"^\s*\{")).alias("is_object"),
                F.try_variant_get("document", "$.rank", "variant").alias("rank"),
                F.try_variant_get("document", "$.rank", "array<variant>").alias("records"),
            )
        ),
    )
    no_list = F.col("records").isNull() & F.col("rank").isNotNull() & ~F.is_variant_null("rank")
    fault = F.when(~F.col("is_object"), "broken document").when(no_list, "rank is no list")

    def row(record: Column, text: Column, fault: Column) -> Column:
        return F.struct(record.alias("record"), text.alias("text"), fault.alias("fault"))

    nothing = F.lit(None).cast("string")
    whole = F.array(row(F.lit(None).cast("variant"), F.col("text"), fault))
    each = F.transform("records", lambda r: row(r, nothing, nothing))
    return listed.select(F.inline(F.when(fault.isNotNull(), whole).otherwise(each)))


def decode_payload(texts: DataFrame, column: str = "value") -> DataFrame:
    """One row per record in the feed's columns, with `raw_line` and `reject_reason`.

    A document that is no JSON object, one whose `rank` is no array of objects, and a
    record with text where a number belongs are marked, each with its own text. No
    `rank` key, or an empty array, means no rows. A record's text is written anew: its keys
    are sorted, and numbers have no zeros at the end of a fraction.

    A document is parsed once, and a record's values are taken as text and typed
    afterwards, so that a wrong one spoils its record alone.
    """
    return decode_records(_records(texts, column))


def decode_records(rows: DataFrame) -> DataFrame:
    """`decode_payload` of parsed records, or texts with their `fault`."""
    words = {name: F.try_variant_get("record", f"$.{name}", "string") for name in FEED.names}
    cells = rows.select(
        "record", "text", "fault", parse_once(F.struct(*[w.alias(n) for n, w in words.items()]))
    )
    typed = typed_once(cells, "record", "text", "fault")
    raw = F.coalesce("text", F.to_json("record"))
    # Only a record without any of the columns may be something else than an object.
    bare = reduce(and_, [F.col(f"_word_{name}").isNull() for name in FEED.names])
    reason = (
        F.when(F.col("fault").isNotNull(), F.col("fault"))
        .when(bare & ~F.coalesce(raw, F.lit("")).startswith("{"), "no record")
        .when(is_mistyped(), "not a number")
    )
    return typed.select(*FEED.names, raw.alias("raw_line"), reason.alias("reject_reason"))


def flatten_payload(texts: DataFrame, column: str = "value") -> DataFrame:
    """The records of `decode_payload` that can be read, bound by name."""
    return accepted(decode_payload(texts, column))
