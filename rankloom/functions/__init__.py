"""Column expressions. All of them stay on the JVM side."""

from rankloom.functions.dates import calendar_fields, coerce_date, coerce_timestamp
from rankloom.functions.dates import epoch_seconds, iso_text
from rankloom.functions.names import first_name, last_name
from rankloom.functions.text import count_fields, csv_line, na_to_null, parse_once

__all__ = [
    "calendar_fields",
    "coerce_date",
    "coerce_timestamp",
    "count_fields",
    "csv_line",
    "epoch_seconds",
    "first_name",
    "iso_text",
    "last_name",
    "na_to_null",
    "parse_once",
]
