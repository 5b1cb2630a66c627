"""Scans: text lines, CSV files, payload documents, status messages, tables."""

from rankloom.sources.large_payload import decode_large_payload
from rankloom.sources.lines import accepted, decode_csv, decode_lines, read_feed_csv, read_lines
from rankloom.sources.lines import rejected
from rankloom.sources.lines import without_headers
from rankloom.sources.payload import decode_payload, flatten_payload, read_payload
from rankloom.sources.status import decode_status, encode_status, mark_status
from rankloom.sources.status import rejected_status

__all__ = [
    "accepted",
    "decode_csv",
    "decode_large_payload",
    "decode_lines",
    "decode_payload",
    "decode_status",
    "encode_status",
    "flatten_payload",
    "mark_status",
    "read_feed_csv",
    "read_lines",
    "read_payload",
    "rejected",
    "rejected_status",
    "without_headers",
]
