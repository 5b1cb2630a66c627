"""Column helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the word rule of quality, and what parts words elsewhere.
BLANKS = " \t\n\x0b\f\r"
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def whole(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def spaced_words(text: Column) -> Column:
    """The words (runs of letters, digits and all beyond ASCII), each between single blanks.

    `" a b "` for two words and `"  "` for none.
    """
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, NOT_WORD, " ")), F.lit(" "))


def word_count(spaced: Column) -> Column:
    return F.when(spaced == "  ", 0).otherwise(spaces(spaced) - 1).cast("long")


def sum_of(numbers: Column, kind: str = "long") -> Column:
    return F.aggregate(numbers, F.lit(0).cast(kind), lambda total, x: total + x)


def running(values: Column, zero: int, combine: Callable[[Column, Column], Column]) -> Column:
    """Per place of an array of whole numbers, what `combine` makes of all before it.

    `combine` is associative, and `zero` its neutral element. An array that grows is copied at every
    step, so each chunk has one of its own, and so has what the chunks come to.
    """
    numbers = "array<bigint>"

    def scan(part: Column) -> Column:
        start = F.struct(
            F.lit(zero).cast("long").alias("total"), F.array().cast(numbers).alias("before")
        )
        return F.aggregate(
            part,
            start,
            lambda state, x: F.struct(
                combine(state["total"], x).cast("long").alias("total"),
                F.array_append(state["before"], state["total"]).alias("before"),
            ),
        )

    def joined(chunks: Column) -> Column:
        offsets = scan(F.transform(chunks, lambda c: c["total"]))["before"]
        return F.flatten(
            F.zip_with(
                chunks, offsets, lambda c, o: F.transform(c["before"], lambda b: combine(o, b))
            )
        )

    def chunked(values: Column) -> Column:
        n = F.size(values)
        length = F.greatest(F.lit(16), F.ceil(F.cbrt(n)).cast("int"))
        starts = F.sequence(F.lit(0), n - 1, length)
        chunks = F.transform(starts, lambda at: scan(F.slice(values, at + 1, length)))
        return F.when(n > 0, let(chunks, joined)).otherwise(F.array().cast(numbers))

    return let(values, chunked)


def running_sum(values: Column) -> Column:
    return running(values, 0, lambda a, b: a + b)


def running_max(values: Column, zero: int) -> Column:
    return running(values, zero, lambda a, b: F.greatest(a, b))


def matches(text: Column, pattern: Column, size: Callable[[Column], Column] = F.length) -> Column:
    """Leftmost non-overlapping matches: array of (text, start, end), measured by `size`.

    What lies between the matches gives their places, so any character may
    occur in the text. The pattern must not match an empty string.
    """
    found = F.regexp_extract_all(text, pattern, F.lit(0))

    def walk(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(hits))
        sized = F.zip_with(
            gaps,
            hits,
            lambda gap, hit: F.struct(
                hit.alias("hit"),
                size(gap).cast("long").alias("gap"),
                size(hit).cast("long").alias("size"),
            ),
        )
        return let(sized, place)

    def place(sized: Column) -> Column:
        before = running_sum(F.transform(sized, lambda s: s["gap"] + s["size"]))
        return F.zip_with(
            sized,
            before,
            lambda s, at: F.struct(
                s["hit"].alias("text"),
                (at + s["gap"]).alias("start"),
                (at + s["gap"] + s["size"]).alias("end"),
            ),
        )

    return let(found, walk)
