"""Dashboard, smoke-check and operations queries over the models.

Each function takes DataFrames and returns a DataFrame; "now" is an
explicit ``as_of`` argument wherever an age is computed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.timefns import as_of_column, elapsed


def _mart_totals(mart: DataFrame, label: str) -> DataFrame:
    return mart.agg(
        F.countDistinct("conversion_id").alias("conversions"),
        F.sum("conversion_value").alias("revenue"),
        F.countDistinct("user_pseudo_id").alias("users"),
    ).select(F.lit(label).alias("model"), "conversions", "revenue", "users")


def attribution_summary(first: DataFrame, last: DataFrame) -> DataFrame:
    """Two rows: conversions, revenue and users per attribution model."""
    return _mart_totals(first, "First-Click").unionByName(_mart_totals(last, "Last-Click"))


def trailing_time_series(comparison: DataFrame, days: int = 14,
                         bound_from: DataFrame | None = None) -> DataFrame:
    """Comparison rows with ``conversion_date >= max(conversion_date) - days``
    (``days + 1`` dates inclusive).  The bound is a scalar subquery.

    ``bound_from`` may name a cheaper table with the same dates, e.g. the
    conversions (every conversion appears in both marts), so the subquery
    does not rebuild the comparison."""
    src = comparison if bound_from is None else bound_from
    max_date = src.select(F.max("conversion_date")).scalar()
    return comparison.where(F.col("conversion_date") >= F.date_sub(max_date, days)).select(
        "conversion_date", "channel", "first_click_conversions", "last_click_conversions",
        "first_click_revenue", "last_click_revenue",
    ).orderBy("conversion_date")


def daily_totals(series: DataFrame) -> DataFrame:
    """Per-date sums of the time series."""
    return series.groupBy("conversion_date").agg(
        *[F.sum(c).alias(c) for c in ("first_click_conversions", "last_click_conversions",
                                       "first_click_revenue", "last_click_revenue")]
    )


def _by_channel(mart: DataFrame, prefix: str) -> DataFrame:
    return mart.groupBy(F.col("attributed_channel").alias("channel")).agg(
        F.countDistinct("conversion_id").alias(f"{prefix}_conversions"),
        F.sum("conversion_value").alias(f"{prefix}_revenue"),
    )


def channel_breakdown(first: DataFrame, last: DataFrame) -> DataFrame:
    j = _by_channel(first, "f").join(_by_channel(last, "l"), "channel", "full")
    return j.select(
        "channel",
        F.coalesce("f_conversions", F.lit(0)).alias("first_click_conversions"),
        F.coalesce("l_conversions", F.lit(0)).alias("last_click_conversions"),
        F.coalesce("f_revenue", F.lit(0.0)).alias("first_click_revenue"),
        F.coalesce("l_revenue", F.lit(0.0)).alias("last_click_revenue"),
    ).orderBy(F.col("last_click_conversions").desc(), F.col("channel"))


def live_events(events: DataFrame, as_of=None, limit: int = 20) -> DataFrame:
    """Newest ``limit`` staged events (top-k: TakeOrderedAndProject)."""
    return events.select(
        "event_id", "event_name", "user_pseudo_id",
        F.col("event_datetime").alias("event_time"),
        F.col("traffic_source").alias("source"),
        F.col("traffic_medium").alias("medium"),
        elapsed("second", "event_datetime", as_of_column(as_of)).alias("seconds_ago"),
    ).orderBy(F.col("event_time").desc(), F.col("event_id")).limit(limit)


def kpi_deltas(summary: DataFrame) -> DataFrame:
    """Last-click minus first-click conversions and revenue (one row)."""
    is_last = F.col("model") == "Last-Click"
    is_first = F.col("model") == "First-Click"
    return summary.agg(
        (F.sum(F.when(is_last, F.col("conversions"))) - F.sum(F.when(is_first, F.col("conversions")))).alias("conversion_delta"),
        (F.sum(F.when(is_last, F.col("revenue"))) - F.sum(F.when(is_first, F.col("revenue")))).alias("revenue_delta"),
    )


# Freshness thresholds (seconds) and labels.
FRESHNESS = ((60, "Live"), (300, "Recent"))
STALE = "Stale"


def feed_freshness(live: DataFrame) -> DataFrame:
    """Age of the newest event and its traffic-light label."""
    age = F.min("seconds_ago")
    label = F.when(age < FRESHNESS[0][0], FRESHNESS[0][1]).when(age < FRESHNESS[1][0], FRESHNESS[1][1]).otherwise(STALE)
    return live.agg(age.alias("min_seconds_ago"), label.alias("freshness"))


def model_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count (all counts in one job)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def first_click_sample(first: DataFrame, limit: int = 10) -> DataFrame:
    """Newest ``limit`` (date, channel) groups of the first-click mart."""
    return first.groupBy("conversion_date", "attributed_channel").agg(
        F.count(F.lit(1)).alias("conversions"),
        F.sum("conversion_value").alias("revenue"),
    ).orderBy(F.col("conversion_date").desc(), F.col("attributed_channel")).limit(limit)


def recent_stream_events(stream: DataFrame, limit: int = 20) -> DataFrame:
    """Newest ``limit`` rows of the streamed table by arrival."""
    return stream.select(
        "event_id", "event_name", "user_pseudo_id",
        F.timestamp_micros("event_timestamp").alias("event_time"),
        F.col("traffic_source.source").alias("source"),
        F.col("traffic_source.medium").alias("medium"),
        "ingestion_timestamp",
    ).orderBy(F.col("ingestion_timestamp").desc(), F.col("event_id")).limit(limit)


def duplicate_event_ids(stream: DataFrame) -> DataFrame:
    """Event ids stored more than once (HAVING count > 1)."""
    return stream.groupBy("event_id").agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def stream_health(stream: DataFrame, as_of=None, hours: int = 1) -> DataFrame:
    """Volume, users and lag of the last ``hours`` of arrivals."""
    now = as_of_column(as_of)
    recent = stream.where(F.col("ingestion_timestamp") >= now - F.make_dt_interval(hours=F.lit(hours)))
    return recent.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.countDistinct("user_pseudo_id").alias("unique_users"),
        F.max("ingestion_timestamp").alias("last_event_time"),
    ).withColumn("seconds_since_last", elapsed("second", F.col("last_event_time"), now))


def approx_unique_users(events: DataFrame, rsd: float = 0.05) -> DataFrame:
    """The exact number of users, and whether the HyperLogLog estimate is
    within three of its standard errors of it."""
    both = events.agg(F.approx_count_distinct("user_pseudo_id", rsd).alias("approx"),
                      F.countDistinct("user_pseudo_id").alias("exact_unique_users"))
    near = F.abs(F.col("approx") - F.col("exact_unique_users")) <= 3 * rsd * F.col("exact_unique_users")
    return both.select("exact_unique_users", near.alias("estimate_within_bound"))


def ingest_latency(stream: DataFrame) -> DataFrame:
    """Arrival minus event time over the streamed rows (seconds)."""
    lag_us = F.unix_micros("ingestion_timestamp") - F.col("event_timestamp")
    return stream.agg(
        F.count(F.lit(1)).alias("events"),
        (F.avg(lag_us) / 1e6).alias("avg_latency_seconds"),
        (F.max(lag_us) / 1e6).alias("max_latency_seconds"),
        (F.min(lag_us) / 1e6).alias("min_latency_seconds"),
    )
