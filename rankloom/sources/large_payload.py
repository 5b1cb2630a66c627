"""Payload files whose one document is too large for one task, cut in parallel.

Files are read in pieces that end with a closing brace, by splits. Quotes before a piece
say whether it begins inside a string, and brackets outside strings how deep it begins;
both are summed up along a split as it is read, the depth for a split that begins outside
a string and for one that begins inside, and the splits before are added up, one row a
split. An object of the list `rank` ends where the depth is back at that of the list; its
pieces are joined where they are read, and none is sorted.

Only files of the ordinary shape are cut: one object, whose one key is `rank`, with a list
of nothing but objects, every one of which parses. Any other file is read whole, so
that the outcome is always that of `decode_payload` over whole files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.text import count_of, parse_once
from rankloom.sources.payload import decode_payload, decode_records, read_payload
from rankloom.sources.runs import SPLIT, joined_rows, scan, sum_of_splits_before, with_sums_before
from rankloom.staging import stage

_HEAD = r'^\s*\{\s*"rank"\s*:\s*\[\s*'
_NEXT = r"^\s*,\s*"
_TAIL = r"^\s*\]\s*$"
# The depth inside the list, where records begin and end.
_LIST = 2


def _depth_change(in_string: Column, ends_in_string: Column) -> Column:
    """Brackets that a piece opens less those it closes, its closing brace included."""
    text = F.regexp_replace(F.col("value"), r"\\.", "")
    text = F.when(in_string, F.regexp_replace(text, r'^[^"]*("|$)', "")).otherwise(text)
    bare = F.regexp_replace(text, r'"[^"]*("|$)', "")
    opened = count_of(bare, "{") + count_of(bare, "[") - count_of(bare, "]")
    return opened - F.when(ends_in_string, 0).otherwise(1)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces with the depth they begin at, and whether a record ends with them."""
    quotes = count_of(F.regexp_replace("value", r"\\.", ""), '"')
    pieces = with_sums_before(scan(spark, path, "}").withColumn("odd", quotes % 2), "odd")
    # As if the split began outside a string; else all of it is the other way round.
    in_string = F.col("odd_before") % 2 == 1
    ends_in_string = (F.col("odd_before") + F.col("odd")) % 2 == 1
    pieces = pieces.withColumns(
        {
            "outer": _depth_change(in_string, ends_in_string),
            "inner": _depth_change(~in_string, ~ends_in_string),
        }
    )
    pieces = stage(with_sums_before(pieces, "outer", "inner"), "payload-pieces")

    sums = pieces.groupBy(*SPLIT).agg(*[F.sum(c).alias(c) for c in ("odd", "outer", "inner")])
    sums = sums.withColumn("_inside", sum_of_splits_before(F.col("odd")) % 2 == 1)
    inside = F.col("_inside")
    change = F.when(inside, F.col("inner")).otherwise(F.col("outer"))
    splits = sums.withColumn("_change", change).select(
        *SPLIT, "_inside", sum_of_splits_before(F.col("_change")).alias("_depth")
    )
    at = F.col("_depth") + F.when(inside, F.col("inner_before")).otherwise(F.col("outer_before"))
    ends = (ends_in_string == inside) & (F.col("at") + change == _LIST)
    placed = pieces.join(stage(splits, "payload-splits"), SPLIT).withColumn("at", at)
    return placed.select(*SPLIT, "place", "value", "at", ends.alias("ends"))


def decode_large_payload(spark: SparkSession, path: str) -> DataFrame:
    """`decode_payload` of files with one document each, of any size, in tasks of one split."""
    pieces = _pieces(spark, path)
    at, value = F.col("at"), F.col("value")
    head = (at == 0) & value.rlike(_HEAD + r"\{")
    tail = (at == _LIST) & value.rlike(_TAIL)
    usual = F.when(at == 0, head | (F.trim(F.translate(value, "\r\n\t", "")) == "")).otherwise(
        F.when(at == _LIST, tail | value.rlike(_NEXT + r"\{")).otherwise(at > _LIST)
    )
    shapes = pieces.groupBy("file").agg(
        (F.bool_and(usual) & (F.count_if(head) == 1) & (F.count_if(tail) == 1)).alias("usual")
    )

    shapes = stage(shapes.where("usual"), "payload-shapes")

    inside = pieces.where((at > _LIST) | ((at == _LIST) & ~tail) | head)
    inside = inside.join(shapes, "file", "left_semi")
    parts = inside.withColumns({"leads": head, "starts": head | (at == _LIST)})
    texts = joined_rows(parts, "}").select("file", F.col("value").alias("text"))
    bare = F.regexp_replace(F.regexp_replace("text", _HEAD, ""), _NEXT, "")
    records = texts.select("file", parse_once(F.struct(F.try_parse_json(F.concat(bare, F.lit("}"))).alias("record"))))
    records = stage(records, "payload-parsed")

    broken = records.where("record IS NULL").select("file").distinct()
    good = shapes.join(broken, "file", "left_anti")
    # Names of files, which the driver has listed for the scan anyway.
    cut = [r.file for r in good.select("file").collect()]
    nothing = F.lit(None).cast("string")
    rows = records.where(F.col("file").isin(cut)).select(
        "record", nothing.alias("text"), nothing.alias("fault")
    )
    others = read_payload(spark, path).where(~F.col("_metadata.file_path").isin(cut))
    return decode_records(rows).unionByName(decode_payload(others))
