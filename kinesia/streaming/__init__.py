"""Structured Streaming: event-time bucketing, query runners, file-backed update output."""

from kinesia.streaming.runner import await_all, await_any, latest_rows, parquet_batches, start_outputs
from kinesia.streaming.windows import event_time, stream_bucketed_mean

__all__ = [
    "await_all",
    "await_any",
    "event_time",
    "latest_rows",
    "parquet_batches",
    "start_outputs",
    "stream_bucketed_mean",
]
