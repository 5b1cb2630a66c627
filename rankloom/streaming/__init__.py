"""Structured Streaming: file arrivals and job status messages."""

from rankloom.streaming.arrivals import arriving_lines, load_arrivals
from rankloom.streaming.status import arriving_status, keep_status, latest_status
from rankloom.streaming.status import refresh_on_success, track_latest_status

__all__ = [
    "arriving_lines",
    "arriving_status",
    "keep_status",
    "latest_status",
    "load_arrivals",
    "refresh_on_success",
    "track_latest_status",
]
