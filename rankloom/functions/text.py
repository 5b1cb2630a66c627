"""Text of CSV lines."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.schemas import FEED, NA_WORDS

# Quotes are doubled inside quoted fields, and blanks around a value are data.
CSV_OPTIONS = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# Spark's default for the option `maxColumns` of its CSV parser.
PARSER_COLUMNS = 20480


def na_to_null(value: Column) -> Column:
    return F.when(~value.isin(*NA_WORDS), value)


def count_of(line: Column, character: str) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(character), F.lit("")))


def count_fields(line: Column) -> Column:
    """Fields of one CSV line; commas inside quotes do not part fields."""
    return count_of(F.regexp_replace(line, '"[^"]*"', ""), ",") + 1


def parsable(line: Column) -> Column:
    """Whether the CSV parser takes the line: it fails a task beyond its column limit."""
    return F.when(count_of(line, ",") < PARSER_COLUMNS, True).otherwise(
        count_fields(line) <= PARSER_COLUMNS
    )


def whole_number(text: Column) -> Column:
    """64-bit integers, also written with a fraction of zeros (`795.0`), else NULL."""
    digits = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)\.0*\s*$", 1)
    fraction = F.when(text.contains("."), digits.try_cast("bigint"))
    return F.coalesce(text.try_cast("bigint"), fraction)


def typed(text: Column, kind: T.DataType) -> Column:
    """Text as a value of `kind`, NULL where it is none."""
    return whole_number(text) if isinstance(kind, T.LongType) else text.try_cast(kind)


def csv_line(*columns: Column | str) -> Column:
    return F.to_csv(F.struct(*columns), CSV_OPTIONS)


def parse_once(parsed: Column) -> Column:
    """The fields of a parsed struct as columns, by a generator over that one struct.

    A parse in a projection is copied into every filter on its fields, and runs
    once for each of them. Filters cannot move below a generator.
    """
    return F.inline(F.array(parsed))


def typed_once(cells: DataFrame, *also: str) -> DataFrame:
    """Cells of text in the feed's types, and as text in `_word_...`; columns kept `also`.

    Behind a generator, so that filters on the typed values do not repeat the casts.
    """
    words = cells.select(*also, *[F.col(name).alias(f"_word_{name}") for name in FEED.names])
    values = [typed(F.col(f"_word_{f.name}"), f.dataType).alias(f.name) for f in FEED]
    return words.select("*", parse_once(F.struct(*values)))


def is_mistyped() -> Column:
    """Whether a row of `typed_once` has text where a number belongs."""
    numbers = [f.name for f in FEED if not isinstance(f.dataType, T.StringType)]
    return reduce(or_, [F.col(f"_word_{n}").isNotNull() & F.col(n).isNull() for n in numbers])
