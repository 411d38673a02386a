"""Streaming twin of the gap sessionizer.

``session_window`` groups a user's events into sessions that close after
``timeout`` of inactivity; ``session_day`` in the keys splits them at UTC
midnight as the batch sessionizer does.  Session windows need an
event-time watermark; ``lateness`` bounds how late an event may arrive
and still join its session.  It is deliberately generous, because late
events should not be lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_gap_sessions(events: DataFrame, timeout_minutes: int = 30, lateness: str = "1 day") -> DataFrame:
    """Append-mode session aggregates over a stream of staged events."""
    ev = events.withWatermark("event_datetime", lateness)
    sw = F.session_window("event_datetime", f"{timeout_minutes} minutes")
    return ev.groupBy("user_pseudo_id", F.to_date("event_datetime").alias("session_day"), sw).agg(
        F.min("event_datetime").alias("session_start"),
        F.max("event_datetime").alias("session_end"),
        F.count(F.lit(1)).alias("events"),
    ).select("user_pseudo_id", "session_day", "session_start", "session_end", "events")
