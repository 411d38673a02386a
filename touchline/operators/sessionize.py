"""Gap-based sessionization (30-minute inactivity, split at UTC midnight).

No window spans a whole user or user-day.  Events are windowed per
(user, time bucket) (default one hour; buckets never cross midnight), which
flags gaps inside a bucket.  A small per-bucket summary (first / last
time, number of new sessions) is then windowed per (user, day), with at
most ``24 * 60 / bucket_minutes`` rows per group.  That tells whether a
bucket's first event opens a session, and how many sessions started in
earlier buckets of the day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.ids import dash_id


def sessionize_by_gap(events: DataFrame, timeout_minutes: int = 30, bucket_minutes: int = 60) -> DataFrame:
    """Per event: ``gap_session_index`` (1-based within user-day) and
    ``gap_session_id``.  A gap of exactly ``timeout_minutes`` stays in the
    same session; a longer gap or a new UTC date starts a new one."""
    if (24 * 60) % bucket_minutes:
        raise ValueError("bucket_minutes must divide a day")
    gap = F.lit(timeout_minutes * 60 * 1_000_000)
    bucket = F.floor(F.col("event_timestamp") / F.lit(bucket_minutes * 60 * 1_000_000)).cast("bigint")
    ev = events.select("event_id", "user_pseudo_id", "event_timestamp", "event_datetime") \
        .withColumns({"session_day": F.to_date("event_datetime"), "_b": bucket})

    in_bucket = Window.partitionBy("user_pseudo_id", "_b").orderBy("event_timestamp", "event_id")
    prev = F.lag("event_timestamp").over(in_bucket)
    ev = ev.withColumn("_new", F.when(prev.isNotNull() & ((F.col("event_timestamp") - prev) > gap), 1).otherwise(0))
    ev = ev.withColumn("_cum", F.sum("_new").over(in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    per_bucket = ev.groupBy("user_pseudo_id", "session_day", "_b").agg(
        F.min("event_timestamp").alias("_first"), F.max("event_timestamp").alias("_last"),
        F.sum("_new").alias("_n_new"))
    day = Window.partitionBy("user_pseudo_id", "session_day").orderBy("_b")
    prev_last = F.lag("_last").over(day)
    per_bucket = per_bucket.withColumn(
        "_opens", F.when(prev_last.isNull() | ((F.col("_first") - prev_last) > gap), 1).otherwise(0))
    per_bucket = per_bucket.withColumn(
        "_offset", F.coalesce(F.sum(F.col("_opens") + F.col("_n_new")).over(
            day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    out = ev.join(per_bucket.select("user_pseudo_id", "_b", "_opens", "_offset"), ["user_pseudo_id", "_b"])
    out = out.withColumn("gap_session_index", (F.col("_offset") + F.col("_opens") + F.col("_cum")).cast("bigint"))
    return out.select("event_id", "user_pseudo_id", "event_timestamp", "event_datetime", "session_day",
                      "gap_session_index").withColumn(
        "gap_session_id", dash_id("user_pseudo_id", F.date_format("session_day", "yyyyMMdd"), "gap_session_index"))


def gap_sessions(assigned: DataFrame) -> DataFrame:
    """One row per gap session: bounds and event count (partial aggregate)."""
    return assigned.groupBy("gap_session_id", "user_pseudo_id", "session_day").agg(
        F.min("event_datetime").alias("session_start"),
        F.max("event_datetime").alias("session_end"),
        F.count(F.lit(1)).alias("events"),
    )


def sessions_by_window(events: DataFrame, timeout_minutes: int = 30) -> DataFrame:
    """Same sessions through ``session_window`` (the form that also runs on a
    stream with a watermark); ``event_date`` in the keys splits at midnight."""
    sw = F.session_window("event_datetime", f"{timeout_minutes} minutes")
    return events.groupBy("user_pseudo_id", F.to_date("event_datetime").alias("session_day"), sw).agg(
        F.min("event_datetime").alias("session_start"),
        F.max("event_datetime").alias("session_end"),
        F.count(F.lit(1)).alias("events"),
    ).drop("session_window")


def top_conversion_per_session(conversions: DataFrame) -> DataFrame:
    """Keep every purchase; of the other conversions of a session keep only
    the highest-priority, highest-value one (ties: earliest, then id), and
    only when the session has no purchase.

    The best conversion per session is a ``min`` over an ordered struct, a
    partial + final aggregate, so a huge session is combined map-side
    rather than sorted in one window task.
    """
    best = conversions.groupBy("session_id").agg(F.min(F.struct(
        F.col("conversion_priority").alias("p"), (-F.col("conversion_value")).alias("v"),
        F.col("conversion_timestamp").alias("t"), F.col("conversion_id").alias("id"),
    )).alias("_best"))
    keep = best.where(F.col("_best.p") != 1).select(
        F.col("session_id").alias("_sid"), F.col("_best.id").alias("_cid"))
    others = conversions.where(F.col("conversion_event") != "purchase")
    others = others.join(keep, (others["conversion_id"] == keep["_cid"])
                         & others["session_id"].eqNullSafe(keep["_sid"]), "left_semi")
    return conversions.where(F.col("conversion_event") == "purchase").unionByName(others)
