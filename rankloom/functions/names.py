"""A full name split at its first blank; further blanks are kept as they are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_name(name: Column) -> Column:
    return F.substring_index(name, " ", 1)


def last_name(name: Column) -> Column:
    """All that follows the first blank: empty for a single word, NULL for NULL."""
    return F.substr(name, F.length(first_name(name)) + F.lit(2))
