"""The same transforms as Structured Streaming jobs."""

from cardtide.streaming.jobs import (
    finish,
    heartbeat,
    minutes_by_arrival,
    minutes_of,
    sliding_hour_of,
    start_bad_messages,
    start_console,
    start_minutes,
    start_raw,
    start_screening,
    state_session,
    unique_transactions,
)
from cardtide.streaming.merge import merge_batch, start_merged
from cardtide.streaming.progress import BatchLog

__all__ = [
    "BatchLog",
    "finish",
    "heartbeat",
    "merge_batch",
    "minutes_by_arrival",
    "minutes_of",
    "sliding_hour_of",
    "start_bad_messages",
    "start_console",
    "start_merged",
    "start_minutes",
    "start_raw",
    "start_screening",
    "state_session",
    "unique_transactions",
]
