"""Ranking lines: scan, header filter, typed decoding and quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.text import CSV_OPTIONS, count_fields, count_of, csv_line, is_mistyped
from rankloom.functions.text import na_to_null, parsable, parse_once, typed_once
from rankloom.schemas import FEED
from rankloom.sources.records import csv_records, has_odd_lines

HEADER_PREFIX = "id,"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, in column `value`."""
    return spark.read.text(path)


def decode_csv(spark: SparkSession, path: str) -> DataFrame:
    """Whole-file scan of CSV, bound by the header's names; shaped as `decode_lines`.

    Columns may stand in any order and be absent (then NULL); a name that is not
    in the contract is an error, and so are files of one scan whose headers differ.
    Long records, text in a number column and a quote that is never closed are marked.
    Fields may hold line breaks; files that have some are cut by `csv_records`.
    """
    options = {"header": True, **CSV_OPTIONS}
    names = spark.read.options(**options).csv(path).columns
    unknown = sorted(set(names) - set(FEED.names))
    if unknown:
        raise ValueError(f"no such columns in the feed: {unknown}")
    given = [F.col(n) if n in names else F.lit(None).cast("string").alias(n) for n in FEED.names]
    misfit = F.col("_misfit")
    # A line with fewer fields than the header is padded, as `decode_lines` does.
    long = misfit.isNotNull() & (count_fields(misfit) > len(names))
    shape = ", ".join(f"`{name}` string" for name in [*names, "_misfit"])
    corrupt = {"columnNameOfCorruptRecord": "_misfit"}
    if not has_odd_lines(spark, path):
        strict = {"enforceSchema": False, **corrupt, **options}
        cells = spark.read.schema(shape).options(**strict).csv(path)
        written = F.coalesce(misfit, csv_line(*names))
        cells = cells.select(*given, written.alias("raw_line"), long.alias("_long"))
        return _typed(cells, [(F.col("_long"), "too many fields")])
    records = csv_records(spark, path)
    headers = [r.value for r in records.where("is_header").select("value").distinct().limit(2).collect()]
    if len(headers) > 1:
        raise ValueError(f"files of one scan have different headers: {headers}")
    text = F.col("value")
    parsed = F.from_csv(F.when(~F.col("is_open"), text), shape, {**corrupt, **CSV_OPTIONS})
    cells = records.where("NOT is_header AND value <> ''").select(
        text.alias("raw_line"), F.col("is_open").alias("_open"), parse_once(parsed)
    )
    cells = cells.select(*given, "raw_line", "_open", long.alias("_long"))
    return _typed(cells, [(F.col("_open"), "open quote"), (F.col("_long"), "too many fields")])


def read_feed_csv(spark: SparkSession, path: str) -> DataFrame:
    """The lines of `decode_csv` that can be read."""
    return accepted(decode_csv(spark, path))


def without_headers(lines: DataFrame) -> DataFrame:
    """Drop header lines wherever they stand, as concatenated files have several."""
    return lines.where(~F.col("value").startswith(HEADER_PREFIX))


def decode_lines(lines: DataFrame, *also: str) -> DataFrame:
    """The feed columns by position, with `raw_line` and `reject_reason`, and columns kept `also`.

    A line with fewer fields than the contract is padded with NULL. A line with
    more, a blank one, one that ends inside quotes and one with text in a number
    column are marked; the reason is NULL for a good line.
    """
    shape = ", ".join(f"`{name}` string" for name in FEED.names) + ", `_misfit` string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_misfit", **CSV_OPTIONS}
    line = F.col("value")
    readable = F.when(parsable(line), line)
    cells = without_headers(lines).select(
        *also,
        line.alias("raw_line"),
        readable.isNull().alias("_unread"),
        parse_once(F.from_csv(readable, shape, options)),
    )

    raw, misfit = F.col("raw_line"), F.col("_misfit").isNotNull()
    return _typed(
        cells,
        [
            (raw == "", "blank line"),
            (F.col("_unread"), "too many fields"),
            (misfit & (count_fields(raw) > len(FEED)), "too many fields"),
            (misfit & (count_of(raw, '"') % 2 == 1), "open quote"),
        ],
        also,
    )


def _typed(
    cells: DataFrame, faults: list[tuple[Column, str]], also: Sequence[str] = ()
) -> DataFrame:
    """Cells of text in the contract's types, with `raw_line` and the first fault's reason."""
    kept = [name for name in cells.columns if name not in FEED.names]
    words = [na_to_null(F.col(name)).alias(name) for name in FEED.names]
    typed = typed_once(cells.select(*kept, parse_once(F.struct(*words))), *kept)
    reason = F.lit(None).cast("string")
    for fault, text in reversed([*faults, (is_mistyped(), "not a number")]):
        reason = F.when(fault, text).otherwise(reason)
    return typed.select(*FEED.names, "raw_line", reason.alias("reject_reason"), *also)


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject_reason").isNull()).select(*FEED.names)


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject_reason").isNotNull()).select("raw_line", "reject_reason")
