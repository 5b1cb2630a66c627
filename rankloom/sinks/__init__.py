"""Table and file sinks, and SQL files."""

from rankloom.sinks.files import write_feed_csv, write_json_records, write_large_payload, write_lines
from rankloom.sinks.sqltext import run_sql, run_sql_file
from rankloom.sinks.warehouse import Warehouse, conform

__all__ = [
    "Warehouse",
    "conform",
    "run_sql",
    "run_sql_file",
    "write_feed_csv",
    "write_json_records",
    "write_large_payload",
    "write_lines",
]
