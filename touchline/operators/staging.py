"""Staging models: events, sessions, conversions.

All three are narrow projections/filters except sessions, which is one
grouped aggregate (partial aggregation map-side, so a hot session key
is combined before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.config import DEFAULT_CONFIG, AttributionConfig
from touchline.functions.channels import channel
from touchline.functions.ids import dash_id
from touchline.functions.params import param
from touchline.functions.timefns import as_of_column, elapsed, minus_days, yyyymmdd_to_date

CONVERSION_FLAG_EVENTS = ("purchase", "begin_checkout", "add_to_cart")
# Conversion priority by event name (anything else is 99).
CONVERSION_PRIORITY = (("purchase", 1), ("begin_checkout", 2), ("add_to_cart", 3))


def _flag(pred: Column) -> Column:
    """CASE WHEN pred THEN true ELSE false END (NULL -> false)."""
    return F.coalesce(pred, F.lit(False))


def stage_events(raw: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG,
                 audit: bool = False) -> DataFrame:
    """Flatten, classify and filter raw nested events (one row per event)."""
    src = raw.where(F.col("event_timestamp").isNotNull() & F.col("user_pseudo_id").isNotNull())
    if cfg.shard_range is not None:
        lo, hi = cfg.shard_range
        # event_date is the shard/partition column: this prunes files.
        src = src.where(F.col("event_date").between(lo, hi))

    strict = cfg.strict_params
    ts_source = F.col("traffic_source.source")
    ts_medium = F.col("traffic_source.medium")
    session_param = param("ga_session_id", "int_value", strict=strict)
    value_param = param("value", "int_value", strict=strict)
    cols = {
        "event_id": dash_id("user_pseudo_id", "event_name", "event_timestamp"),
        "event_date": F.col("event_date"),
        "event_timestamp": F.col("event_timestamp"),
        "event_datetime": F.timestamp_micros("event_timestamp"),
        "event_name": F.col("event_name"),
        "user_pseudo_id": F.col("user_pseudo_id"),
        "user_id": F.col("user_id"),
        "session_id": dash_id("user_pseudo_id", session_param),
        "ga_session_id": session_param,
        "ga_session_number": param("ga_session_number", "int_value", strict=strict),
        "traffic_source": F.coalesce(ts_source, F.lit("(direct)")),
        "traffic_medium": F.coalesce(ts_medium, F.lit("(none)")),
        "traffic_campaign": F.col("traffic_source.name"),
        "channel": channel(ts_source, ts_medium),
        "device_category": F.col("device.category"),
        "device_os": F.col("device.operating_system"),
        "device_browser": F.col("device.web_info.browser"),
        "country": F.col("geo.country"),
        "region": F.col("geo.region"),
        "city": F.col("geo.city"),
        "transaction_id": F.col("ecommerce.transaction_id"),
        "purchase_revenue": F.col("ecommerce.purchase_revenue"),
        "total_item_quantity": F.col("ecommerce.total_item_quantity"),
        "page_location": param("page_location", "string_value", strict=strict),
        "page_title": param("page_title", "string_value", strict=strict),
        "engagement_time_msec": param("engagement_time_msec", "int_value", strict=strict),
        "session_engaged": param("session_engaged", "string_value", strict=strict),
        "event_value_param": value_param,
        "event_value": F.coalesce(F.col("ecommerce.purchase_revenue"), value_param.cast("double")),
        "platform": F.col("platform"),
        "stream_id": F.col("stream_id"),
    }
    if audit:
        cols["_loaded_at"] = F.current_timestamp()
    flat = src.select(*[c.alias(n) for n, c in cols.items()])

    staged = flat.withColumns({
        "is_direct_traffic": _flag((F.col("traffic_source") == "(direct)") & (F.col("traffic_medium") == "(none)")),
        "is_conversion_event": _flag(F.col("event_name").isin(*CONVERSION_FLAG_EVENTS)),
        "is_pageview": _flag(F.col("event_name") == "page_view"),
        "is_session_start": _flag((F.col("event_name") == "session_start") | (F.col("ga_session_number") == 1)),
    }).where(
        F.col("event_name").isNotNull()
        & (F.col("event_datetime") >= F.lit(cfg.min_event_time).cast("timestamp"))
        & (F.col("event_datetime") <= as_of_column(cfg.as_of))
    )
    if cfg.dedup_events:
        staged = staged.dropDuplicates(["event_id"])
    return staged


def first_by_time(*cols: str, order: str = "event_timestamp") -> Column:
    """Struct of ``cols`` from the earliest row of the group.

    ``min(struct(order, cols...))`` orders by time, then by the payload, so
    the pick is deterministic on ties and NULL payloads are kept.
    """
    return F.min(F.struct(F.col(order).alias("_t"), *[F.col(c) for c in cols]))


SESSION_FIRST_COLS = (
    "traffic_source", "traffic_medium", "traffic_campaign", "channel",
    "device_category", "device_os", "device_browser", "country", "region", "city",
    "page_location",
)


def stage_sessions(events: DataFrame, audit: bool = False) -> DataFrame:
    """One row per (session_id, user_pseudo_id, user_id)."""
    is_purchase = F.col("event_name") == "purchase"
    agg = events.groupBy("session_id", "user_pseudo_id", "user_id").agg(
        F.min("event_datetime").alias("session_start_time"),
        F.max("event_datetime").alias("session_end_time"),
        first_by_time(*SESSION_FIRST_COLS).alias("_first"),
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("is_pageview")).alias("pageviews"),
        F.count_if(F.col("is_conversion_event")).alias("conversion_events"),
        F.count_if(is_purchase).alias("purchases"),
        (F.sum("engagement_time_msec") / 1000).alias("engagement_time_seconds"),
        F.bool_or(_flag(F.col("session_engaged") == "1")).alias("is_engaged_session"),
        F.sum(F.when(is_purchase, F.coalesce(F.col("purchase_revenue"), F.lit(0.0))).otherwise(F.lit(0.0))).alias("session_revenue"),
        F.max("ga_session_number").alias("ga_session_number"),
        F.bool_or("is_direct_traffic").alias("is_direct_traffic"),
        F.bool_or(_flag(is_purchase)).alias("has_purchase"),
        F.bool_or(_flag(F.col("event_name") == "begin_checkout")).alias("has_checkout"),
        F.bool_or(_flag(F.col("event_name") == "add_to_cart")).alias("has_add_to_cart"),
    )
    first = {c: F.col(f"_first.{c}") for c in SESSION_FIRST_COLS}
    out = [
        F.col("session_id"), F.col("user_pseudo_id"), F.col("user_id"),
        F.to_date("session_start_time").alias("session_date"),
        F.col("session_start_time"), F.col("session_end_time"),
        elapsed("second", "session_start_time", "session_end_time").alias("session_duration_seconds"),
        first["traffic_source"].alias("session_traffic_source"),
        first["traffic_medium"].alias("session_traffic_medium"),
        first["traffic_campaign"].alias("session_traffic_campaign"),
        first["channel"].alias("session_channel"),
        first["device_category"].alias("device_category"),
        first["device_os"].alias("device_os"),
        first["device_browser"].alias("device_browser"),
        first["country"].alias("country"),
        first["region"].alias("region"),
        first["city"].alias("city"),
        "total_events", "pageviews", "conversion_events", "purchases",
        "engagement_time_seconds", "is_engaged_session", "session_revenue",
        first["page_location"].alias("landing_page"),
        "ga_session_number", "is_direct_traffic", "has_purchase", "has_checkout", "has_add_to_cart",
    ]
    if audit:
        out.append(F.current_timestamp().alias("_updated_at"))
    return agg.select(*out)


def stage_conversions(events: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG,
                      audit: bool = False) -> DataFrame:
    """Conversion events with their lookback window bounds."""
    conv = events.where(
        F.col("event_name").isin(*cfg.conversion_events)
        & F.col("user_pseudo_id").isNotNull()
        & F.col("event_datetime").isNotNull()
        & (F.col("event_datetime") >= F.lit(cfg.min_event_time).cast("timestamp"))
    )
    priority = None
    for name, rank in CONVERSION_PRIORITY:
        cond = F.col("event_name") == name
        priority = F.when(cond, rank) if priority is None else priority.when(cond, rank)
    priority = priority.otherwise(99)

    out = [
        dash_id("user_pseudo_id", "event_name", "event_timestamp").alias("conversion_id"),
        F.col("event_id"),
        yyyymmdd_to_date("event_date").alias("conversion_date"),
        F.col("event_datetime").alias("conversion_datetime"),
        F.col("event_timestamp").alias("conversion_timestamp"),
        F.col("event_name").alias("conversion_event"),
        "user_pseudo_id", "user_id", "session_id",
        F.coalesce(F.col("purchase_revenue"), F.col("event_value"), F.lit(0.0)).alias("conversion_value"),
        "transaction_id", "total_item_quantity",
        minus_days("event_datetime", cfg.lookback_days).alias("attribution_window_start"),
        F.col("event_datetime").alias("attribution_window_end"),
        F.col("channel").alias("conversion_channel"),
        F.col("traffic_source").alias("conversion_traffic_source"),
        F.col("page_location").alias("conversion_page"),
        "device_category", "device_os", "country", "city",
        priority.cast("int").alias("conversion_priority"),
    ]
    if audit:
        out.append(F.current_timestamp().alias("_loaded_at"))
    conv = conv.select(*out)
    if cfg.exclude_negative_revenue:
        conv = conv.where(F.col("conversion_value") >= 0)
    return conv
