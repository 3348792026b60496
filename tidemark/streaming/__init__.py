"""Streaming twins of the operators.  Each returns a writer or a DataFrame; callers start it."""

from tidemark.streaming.events import change_events
from tidemark.streaming.expiring import ExpiryWheel, live_state, ttl_state, wheel_state
from tidemark.streaming.sinks import (
    latest_stream,
    resume_stream,
    resume_to,
    stream_append,
    stream_to,
    stream_upsert,
    track,
)

__all__ = [
    "ExpiryWheel",
    "live_state",
    "change_events",
    "latest_stream",
    "resume_stream",
    "resume_to",
    "stream_append",
    "stream_to",
    "stream_upsert",
    "track",
    "ttl_state",
    "wheel_state",
]
