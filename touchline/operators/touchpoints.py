"""Touchpoints: events grouped to one row per marketing touch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.ids import dash_id
from touchline.functions.timefns import yyyymmdd_to_date
from touchline.operators.staging import first_by_time

# Grouping keys of the session grain, as the model code groups.
SESSION_GRAIN_KEYS = (
    "user_pseudo_id", "user_id", "session_id", "event_date",
    "channel", "traffic_source", "traffic_medium", "traffic_campaign",
)
CHANNEL_DAY_KEYS = ("user_pseudo_id", "event_date", "channel")

TOUCHPOINT_COLUMNS = (
    "touchpoint_id", "user_pseudo_id", "user_id", "session_id", "touchpoint_date",
    "touchpoint_datetime", "touchpoint_timestamp", "channel", "traffic_source",
    "traffic_medium", "traffic_campaign", "landing_page", "touchpoint_event_count",
    "touchpoint_pageviews", "touchpoint_engagement_seconds", "device_category",
    "country", "is_direct_traffic",
)


def touchpoints(events: DataFrame, grain: str = "session", audit: bool = False) -> DataFrame:
    """Group events into touchpoints.

    ``grain="session"``: one row per user, user id, session, day, channel
    and source/medium/campaign (so ``touchpoint_id`` may repeat).
    ``grain="channel_day"``: one row per user-channel-day; the session and
    source fields come from the day's first event in that channel.

    The aggregate is partial + final: a hot user's events are combined
    map-side before the shuffle.
    """
    ev = events.where(F.col("user_pseudo_id").isNotNull() & F.col("channel").isNotNull())
    if grain == "session":
        keys = SESSION_GRAIN_KEYS
        first_cols = ("page_location", "device_category", "country")
    elif grain == "channel_day":
        keys = CHANNEL_DAY_KEYS
        first_cols = ("page_location", "device_category", "country", "user_id", "session_id",
                      "traffic_source", "traffic_medium", "traffic_campaign")
    else:
        raise ValueError(f"unknown touchpoint grain {grain!r}")

    agg = ev.groupBy(*keys).agg(
        F.min("event_datetime").alias("touchpoint_datetime"),
        F.min("event_timestamp").alias("touchpoint_timestamp"),
        first_by_time(*first_cols).alias("_first"),
        F.count(F.lit(1)).alias("touchpoint_event_count"),
        F.count_if(F.col("is_pageview")).alias("touchpoint_pageviews"),
        (F.sum("engagement_time_msec") / 1000).alias("touchpoint_engagement_seconds"),
        F.bool_or("is_direct_traffic").alias("is_direct_traffic"),
    )
    cols = {c: F.col(c) for c in keys}
    for c in first_cols:
        if c not in cols:
            cols[c] = F.col(f"_first.{c}")
    cols["landing_page"] = F.col("_first.page_location")
    cols["touchpoint_id"] = dash_id("user_pseudo_id", "channel", "event_date")
    cols["touchpoint_date"] = yyyymmdd_to_date("event_date")
    for c in ("touchpoint_datetime", "touchpoint_timestamp", "touchpoint_event_count",
              "touchpoint_pageviews", "touchpoint_engagement_seconds", "is_direct_traffic"):
        cols[c] = F.col(c)
    out = [cols[c].alias(c) for c in TOUCHPOINT_COLUMNS]
    if audit:
        out.append(F.current_timestamp().alias("_updated_at"))
    return agg.select(*out)
