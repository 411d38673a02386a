"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and the
matching DuckDB oracle SQL.

Each query reads the driver tables under ``sf_dir`` (or data Spark
derives from them) in full.  Output timestamps are ``TIMESTAMP_NTZ`` so
they compare with DuckDB's naive TIMESTAMP; float sums are rounded to 2
places and averages / percentages to 6 on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.config import AttributionConfig
from touchline.plans import serving
from touchline.plans.models import Models
from touchline.plans.oracle import AS_OF, IDENTITY, STITCHED, STREAM_AS_OF, q
from touchline.session import ensure_utc, materialize
from touchline.operators.credit import credit_by_channel, journey_shares
from touchline.operators.funnel import LIMIT_HOURS, STEPS, funnel_by_channel, funnel_progress
from touchline.operators.identity import stitch, user_identity
from touchline.operators.quality import (
    CUSTOM_CHECKS, MODEL_CHECKS, Check, checked_columns, count_failures, oracle_check_sql, read_failures, run_checks, store_failures,
)
from touchline.operators.sketches import STANDARD_ERROR, store_sketches, users_in_range
from touchline.operators.sessionize import (
    gap_sessions, sessionize_by_gap, sessions_by_window, top_conversion_per_session,
)
from touchline.sources.adapter import with_logins
from touchline.operators.staging import stage_events
from touchline.sources.scan import raw_events, read_sharded_events
from touchline.sources.schemas import RAW_EVENT_SCHEMA
from touchline.sources.snapshots import Generation
from touchline.streaming.refresh_all import build_all, refresh_all
from touchline.streaming.session_state import current_sessions, store_session_changes
from touchline.sources.sinks import (
    apply_retention, export_partition, read_event_table, register_views, restore_partition, retain_in_place, write_clustered, write_incremental, write_mart,
)
from touchline.streaming.ingest import (
    STREAM_EVENT_SCHEMA, first_arrivals, ingest, new_scratch, resends, stream_rows_from_raw, with_resends, write_json_lines,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


# "Now" for the sane-time filter, fixed once per process so every model of
# a run uses the same cut-off (and the same compiled code).
RUN_AS_OF = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0).isoformat(sep=" ")


def models(spark: SparkSession, sf_dir: str, **kw) -> Models:
    ensure_utc(spark)
    cfg = kw.pop("cfg", AttributionConfig(as_of=RUN_AS_OF))
    return Models(raw_events(spark, sf_dir), cfg, **kw)


def ntz(df: DataFrame) -> DataFrame:
    """Timestamps as TIMESTAMP_NTZ (UTC wall clock) for engine-neutral output."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def rounded(df: DataFrame, cents: tuple[str, ...] = (), fine: tuple[str, ...] = ()) -> DataFrame:
    return df.withColumns({**{c: F.round(c, 2) for c in cents}, **{c: F.round(c, 6) for c in fine}})


def _sql_round(cols: list[str], cents=(), fine=()) -> str:
    out = []
    for c in cols:
        if c in cents:
            out.append(f"round({c}, 2) AS {c}")
        elif c in fine:
            out.append(f"round({c}, 6) AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


# ---------------------------------------------------------------- models
@register("stg_ga4_events", q("SELECT * FROM stg_events"))
def q_stg_events(spark, sf_dir):
    return ntz(models(spark, sf_dir).events)


SESSION_CENTS = ("session_revenue",)


@register("stg_ga4_sessions", q("SELECT * REPLACE (round(session_revenue, 2) AS session_revenue) FROM stg_sessions"))
def q_stg_sessions(spark, sf_dir):
    return ntz(rounded(models(spark, sf_dir).sessions, SESSION_CENTS))


@register("stg_ga4_conversions", q("SELECT * FROM stg_conversions"))
def q_stg_conversions(spark, sf_dir):
    return ntz(models(spark, sf_dir).conversions)


@register("int_touchpoints", q("SELECT * FROM int_touchpoints"))
def q_touchpoints(spark, sf_dir):
    return ntz(models(spark, sf_dir).touchpoints)


@register("int_touchpoints_channel_day", q("""
SELECT user_pseudo_id || '-' || channel || '-' || event_date AS touchpoint_id,
  user_pseudo_id,
  arg_min_null(user_id, event_timestamp) AS user_id,
  arg_min_null(session_id, event_timestamp) AS session_id,
  CAST(strptime(event_date, '%Y%m%d') AS DATE) AS touchpoint_date,
  min(event_datetime) AS touchpoint_datetime, min(event_timestamp) AS touchpoint_timestamp,
  channel,
  arg_min_null(traffic_source, event_timestamp) AS traffic_source,
  arg_min_null(traffic_medium, event_timestamp) AS traffic_medium,
  arg_min_null(traffic_campaign, event_timestamp) AS traffic_campaign,
  arg_min_null(page_location, event_timestamp) AS landing_page,
  count(*) AS touchpoint_event_count, count_if(is_pageview) AS touchpoint_pageviews,
  sum(engagement_time_msec) / 1000 AS touchpoint_engagement_seconds,
  arg_min_null(device_category, event_timestamp) AS device_category,
  arg_min_null(country, event_timestamp) AS country,
  bool_or(is_direct_traffic) AS is_direct_traffic
FROM stg_events WHERE user_pseudo_id IS NOT NULL AND channel IS NOT NULL
GROUP BY user_pseudo_id, event_date, channel"""))
def q_touchpoints_channel_day(spark, sf_dir):
    cfg = AttributionConfig(as_of=RUN_AS_OF, touchpoint_grain="channel_day")
    return ntz(models(spark, sf_dir, cfg=cfg).touchpoints)


@register("int_user_journeys", q("SELECT * FROM int_user_journeys"))
def q_journeys(spark, sf_dir):
    return ntz(models(spark, sf_dir).journeys)


@register("int_user_journeys_windowed", q("SELECT * FROM int_user_journeys"))
def q_journeys_windowed(spark, sf_dir):
    return ntz(models(spark, sf_dir, journey_plan="windowed").journeys)


@register("mart_first_click_attribution", q("SELECT * FROM mart_first_click"))
def q_first(spark, sf_dir):
    return ntz(models(spark, sf_dir).first_click)


@register("mart_last_click_attribution", q("SELECT * FROM mart_last_click"))
def q_last(spark, sf_dir):
    return ntz(models(spark, sf_dir).last_click)


@register("mart_first_click_rank_summary", q("SELECT * FROM mart_first_click"))
def q_first_rank(spark, sf_dir):
    """The mart from an aggregate of ordered structs over the pairs."""
    return ntz(models(spark, sf_dir, mart_summary="struct").first_click)


@register("mart_first_click_windowed", q("SELECT * FROM mart_first_click"))
def q_first_windowed(spark, sf_dir):
    return ntz(models(spark, sf_dir, mart_plan="windowed", journey_plan="windowed").first_click)


@register("mart_last_click_windowed", q("SELECT * FROM mart_last_click"))
def q_last_windowed(spark, sf_dir):
    return ntz(models(spark, sf_dir, mart_plan="windowed", journey_plan="windowed").last_click)


# Every tenth raw event delivered twice: conversion ids then repeat.
REPLAYS = "SELECT * FROM flat UNION ALL SELECT * FROM flat WHERE event_timestamp % 10 = 0"


def replayed_models(spark: SparkSession, sf_dir: str, **kw) -> Models:
    m = models(spark, sf_dir, **kw)
    m.raw = m.raw.unionByName(m.raw.where(F.col("event_timestamp") % 10 == 0))
    return m


@register("journeys_with_replays", q("SELECT * FROM int_user_journeys", flat=REPLAYS))
def q_journeys_replays(spark, sf_dir):
    return ntz(replayed_models(spark, sf_dir).journeys)


@register("marts_with_replays", q("""
SELECT * RENAME (first_touch_to_conversion_days AS touch_to_conversion_days) FROM mart_first_click
UNION ALL BY NAME
SELECT * RENAME (last_touch_to_conversion_days AS touch_to_conversion_days) FROM mart_last_click""", flat=REPLAYS))
def q_marts_replays(spark, sf_dir):
    m = replayed_models(spark, sf_dir)
    both = [df.withColumnRenamed(f"{x}_touch_to_conversion_days", "touch_to_conversion_days")
            for x, df in (("first", m.first_click), ("last", m.last_click))]
    return ntz(both[0].unionByName(both[1]))


COMPARISON_COLS = [
    "channel", "conversion_date", "first_click_conversions", "first_click_revenue",
    "avg_journey_days_fc", "avg_touchpoints_fc", "last_click_conversions", "last_click_revenue",
    "avg_journey_days_lc", "avg_touchpoints_lc", "conversion_shift", "revenue_shift",
    "conversion_shift_percent", "revenue_shift_percent",
]
COMPARISON_CENTS = ("first_click_revenue", "last_click_revenue", "revenue_shift")
COMPARISON_FINE = ("avg_journey_days_fc", "avg_touchpoints_fc", "avg_journey_days_lc",
                   "avg_touchpoints_lc", "conversion_shift_percent", "revenue_shift_percent")


def comparison_out(df: DataFrame) -> DataFrame:
    """Registered form of the comparison: revenue in cents, and the revenue
    shift and its percentage derived from the cent values (the sums are
    whole cents, so this is exact and independent of summation order);
    averages and the conversion percentage to 6 places."""
    fr, lr = F.round("first_click_revenue", 2), F.round("last_click_revenue", 2)
    return df.withColumns({
        "first_click_revenue": fr, "last_click_revenue": lr,
        "revenue_shift": F.round(lr - fr, 2),
        "revenue_shift_percent": F.round(F.when(fr > 0, (lr - fr) / fr * 100), 6),
        **{c: F.round(c, 6) for c in COMPARISON_FINE if c != "revenue_shift_percent"},
    })


_COMPARISON_OUT_SQL = """
SELECT channel, conversion_date, first_click_conversions, round(first_click_revenue, 2) AS first_click_revenue,
  round(avg_journey_days_fc, 6) AS avg_journey_days_fc, round(avg_touchpoints_fc, 6) AS avg_touchpoints_fc,
  last_click_conversions, round(last_click_revenue, 2) AS last_click_revenue,
  round(avg_journey_days_lc, 6) AS avg_journey_days_lc, round(avg_touchpoints_lc, 6) AS avg_touchpoints_lc,
  conversion_shift,
  round(round(last_click_revenue, 2) - round(first_click_revenue, 2), 2) AS revenue_shift,
  round(conversion_shift_percent, 6) AS conversion_shift_percent,
  round(CASE WHEN round(first_click_revenue, 2) > 0
        THEN (round(last_click_revenue, 2) - round(first_click_revenue, 2)) / round(first_click_revenue, 2) * 100
        END, 6) AS revenue_shift_percent
FROM mart_attribution_comparison ORDER BY conversion_date DESC, channel"""


@register("mart_attribution_comparison", q(_COMPARISON_OUT_SQL))
def q_comparison(spark, sf_dir):
    return comparison_out(models(spark, sf_dir).comparison)


@register("mart_attribution_comparison_two_marts", q(_COMPARISON_OUT_SQL))
def q_comparison_two_marts(spark, sf_dir):
    """The comparison as a full outer join of the two marts."""
    from touchline.operators.comparison import attribution_comparison
    m = models(spark, sf_dir)
    return comparison_out(attribution_comparison(m.first_click, m.last_click))


# ---------------------------------------------------------------- serving
@register("attribution_summary", q("""
SELECT 'First-Click' AS model, count(DISTINCT conversion_id) AS conversions,
       round(sum(conversion_value), 2) AS revenue, count(DISTINCT user_pseudo_id) AS users
FROM mart_first_click
UNION ALL
SELECT 'Last-Click', count(DISTINCT conversion_id), round(sum(conversion_value), 2),
       count(DISTINCT user_pseudo_id)
FROM mart_last_click"""))
def q_summary(spark, sf_dir):
    return rounded(serving.attribution_summary(*models(spark, sf_dir).mart_totals()), ("revenue",))


@register("attribution_summary_with_replays", q("""
SELECT 'First-Click' AS model, count(DISTINCT conversion_id) AS conversions,
       round(sum(conversion_value), 2) AS revenue, count(DISTINCT user_pseudo_id) AS users
FROM mart_first_click
UNION ALL
SELECT 'Last-Click', count(DISTINCT conversion_id), round(sum(conversion_value), 2),
       count(DISTINCT user_pseudo_id)
FROM mart_last_click""", flat=REPLAYS))
def q_summary_replays(spark, sf_dir):
    """The totals when every tenth event came twice."""
    return rounded(serving.attribution_summary(*replayed_models(spark, sf_dir).mart_totals()), ("revenue",))


SERIES_CENTS = ("first_click_revenue", "last_click_revenue")
_SERIES_SQL = """
SELECT conversion_date, channel, first_click_conversions, last_click_conversions,
       first_click_revenue, last_click_revenue
FROM mart_attribution_comparison
WHERE conversion_date >= (SELECT max(conversion_date) - INTERVAL 14 DAY FROM mart_attribution_comparison)"""


@register("trailing_time_series", q(
    f"SELECT * REPLACE (round(first_click_revenue, 2) AS first_click_revenue, "
    f"round(last_click_revenue, 2) AS last_click_revenue) FROM ({_SERIES_SQL}) s ORDER BY conversion_date"))
def q_series(spark, sf_dir):
    m = models(spark, sf_dir)
    return rounded(serving.trailing_time_series(m.comparison, bound_from=m.conversions), SERIES_CENTS)


@register("daily_totals", q(f"""
SELECT conversion_date,
  CAST(sum(first_click_conversions) AS BIGINT) AS first_click_conversions,
  CAST(sum(last_click_conversions) AS BIGINT) AS last_click_conversions,
  round(sum(first_click_revenue), 2) AS first_click_revenue,
  round(sum(last_click_revenue), 2) AS last_click_revenue
FROM ({_SERIES_SQL}) s GROUP BY conversion_date"""))
def q_daily(spark, sf_dir):
    m = models(spark, sf_dir)
    series = serving.trailing_time_series(m.comparison, bound_from=m.conversions)
    return rounded(serving.daily_totals(series), SERIES_CENTS)


@register("channel_breakdown", q("""
SELECT coalesce(f.channel, l.channel) AS channel,
  coalesce(f.conversions, 0) AS first_click_conversions,
  coalesce(l.conversions, 0) AS last_click_conversions,
  round(coalesce(f.revenue, 0), 2) AS first_click_revenue,
  round(coalesce(l.revenue, 0), 2) AS last_click_revenue
FROM (SELECT attributed_channel AS channel, count(DISTINCT conversion_id) AS conversions,
             sum(conversion_value) AS revenue FROM mart_first_click GROUP BY 1) f
FULL OUTER JOIN (SELECT attributed_channel AS channel, count(DISTINCT conversion_id) AS conversions,
             sum(conversion_value) AS revenue FROM mart_last_click GROUP BY 1) l
  ON f.channel = l.channel
ORDER BY last_click_conversions DESC, channel"""))
def q_channels(spark, sf_dir):
    m = models(spark, sf_dir)
    return rounded(m.channel_breakdown(), SERIES_CENTS)


_LIVE_SQL = f"""
SELECT event_id, event_name, user_pseudo_id, event_datetime AS event_time,
       traffic_source AS source, traffic_medium AS medium,
       date_sub('second', event_datetime, TIMESTAMP '{AS_OF}') AS seconds_ago
FROM stg_events ORDER BY event_time DESC, event_id LIMIT 20"""


@register("live_events", q(_LIVE_SQL))
def q_live(spark, sf_dir):
    return ntz(serving.live_events(models(spark, sf_dir).events, as_of=AS_OF))


@register("kpi_deltas", q("""
SELECT CAST((SELECT count(DISTINCT conversion_id) FROM mart_last_click)
          - (SELECT count(DISTINCT conversion_id) FROM mart_first_click) AS BIGINT) AS conversion_delta,
       round((SELECT round(sum(conversion_value), 2) FROM mart_last_click)
          - (SELECT round(sum(conversion_value), 2) FROM mart_first_click), 2) AS revenue_delta"""))
def q_kpi(spark, sf_dir):
    summary = rounded(serving.attribution_summary(*models(spark, sf_dir).mart_totals()), ("revenue",))
    return rounded(serving.kpi_deltas(summary), ("revenue_delta",))


@register("feed_freshness", q(f"""
SELECT min(seconds_ago) AS min_seconds_ago,
  CASE WHEN min(seconds_ago) < 60 THEN 'Live' WHEN min(seconds_ago) < 300 THEN 'Recent' ELSE 'Stale' END AS freshness
FROM ({_LIVE_SQL}) l"""))
def q_freshness(spark, sf_dir):
    return serving.feed_freshness(serving.live_events(models(spark, sf_dir).events, as_of=AS_OF))


_COUNTED = (
    ("stg_ga4_events", "stg_events"), ("stg_ga4_conversions", "stg_conversions"),
    ("int_touchpoints", "int_touchpoints"), ("int_user_journeys", "int_user_journeys"),
    ("mart_first_click", "mart_first_click"), ("mart_last_click", "mart_last_click"),
)


@register("model_row_counts", q(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}" for name, cte in _COUNTED)))
def q_counts(spark, sf_dir):
    m = models(spark, sf_dir).materialize_shared()
    tables = {"stg_ga4_events": m.events, "stg_ga4_conversions": m.conversions,
              "int_touchpoints": m.touchpoints, "int_user_journeys": m.journeys,
              "mart_first_click": m.first_click, "mart_last_click": m.last_click}
    return serving.model_row_counts(tables)


@register("first_click_sample", q("""
SELECT conversion_date, attributed_channel, count(*) AS conversions,
       round(sum(conversion_value), 2) AS revenue
FROM mart_first_click GROUP BY conversion_date, attributed_channel
ORDER BY conversion_date DESC, attributed_channel LIMIT 10"""))
def q_sample(spark, sf_dir):
    return rounded(serving.first_click_sample(models(spark, sf_dir).first_click), ("revenue",))


@register("linear_attribution", q("""
SELECT channel, round(sum(conversion_value / total_touchpoints), 2) AS total_attributed_value
FROM int_user_journeys GROUP BY channel"""))
def q_linear(spark, sf_dir):
    return rounded(models(spark, sf_dir).linear(), ("total_attributed_value",))


HALF_LIFE_DAYS = 7


@register("time_decay_attribution", q(f"""
SELECT channel, round(sum(conversion_value * w / total), 2) AS total_attributed_value
FROM (SELECT *, sum(w) OVER (PARTITION BY conversion_id) AS total
      FROM (SELECT *, 2 ** ((touchpoint_timestamp - conversion_timestamp) / (86400e6 * {HALF_LIFE_DAYS})) AS w FROM int_user_journeys))
GROUP BY channel"""))
def q_time_decay(spark, sf_dir):
    """Credit that halves with every week between touch and conversion, by channel."""
    return rounded(models(spark, sf_dir).time_decay(HALF_LIFE_DAYS), ("total_attributed_value",))


@register("journey_shares_time_decay", q(f"""
SELECT conversion_id, any_value(conversion_value) AS value, channel, round(sum(w) / any_value(total), 6) AS share
FROM (SELECT *, sum(w) OVER (PARTITION BY conversion_id) AS total
      FROM (SELECT *, 2 ** ((touchpoint_timestamp - conversion_timestamp) / (86400e6 * {HALF_LIFE_DAYS})) AS w FROM int_user_journeys))
GROUP BY conversion_id, channel"""))
def q_decay_shares(spark, sf_dir):
    """Every conversion's shares by channel, that sum to 1."""
    m = models(spark, sf_dir)
    return rounded(journey_shares(m.conversions, m.touchpoints, m.cfg.lookback_days, HALF_LIFE_DAYS), (), ("share",))


_FUNNEL = f"""
, f1 AS (
  SELECT user_pseudo_id AS u, event_timestamp AS t, list_position({list(STEPS)}, event_name) AS step, max(channel) AS channel
  FROM stg_events WHERE event_name IN {STEPS} GROUP BY ALL
), f2 AS (
  SELECT *, CASE WHEN step = 1 THEN t END AS a1, max(t) FILTER (step = 1) OVER w AS p1 FROM f1
  WINDOW w AS (PARTITION BY u ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f3 AS (
  SELECT *, CASE WHEN step = 2 AND t - p1 <= {LIMIT_HOURS} * 3600000000 THEN p1 END AS a2 FROM f2
), f4 AS (
  SELECT *, max(a2) OVER (PARTITION BY u ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p2 FROM f3
), f5 AS (
  SELECT *, CASE WHEN step = 3 AND t - p2 <= {LIMIT_HOURS} * 3600000000 THEN p2 END AS a3 FROM f4
), f6 AS (
  SELECT *, max(a3) OVER (PARTITION BY u ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p3 FROM f5
), f7 AS (
  SELECT *, CASE WHEN step = 4 AND t - p3 <= {LIMIT_HOURS} * 3600000000 THEN p3 END AS a4 FROM f6
), reached AS (
  SELECT u, step, min(t) AS reached_at, arg_min(coalesce(a1, a2, a3, a4), t) AS started_at
  FROM f7 WHERE coalesce(a1, a2, a3, a4) IS NOT NULL GROUP BY u, step
), progress AS (
  SELECT r.u AS user_pseudo_id, CAST(r.step AS INT) AS step, reached_at, started_at, s.channel
  FROM reached r JOIN f1 s ON s.u = r.u AND s.t = r.started_at AND s.step = 1
)"""


def after_ctes(more: str, select: str) -> str:
    """SQL with further CTEs after the shared ones."""
    return q("").rstrip() + more + "\n" + select


@register("funnel_progress", after_ctes(_FUNNEL, "SELECT * FROM progress"))
def q_funnel_progress(spark, sf_dir):
    """When every user first reached each step of the funnel, and from which start."""
    return funnel_progress(models(spark, sf_dir).events)


@register("conversion_funnel", after_ctes(_FUNNEL, f"""
SELECT channel, step, {list(STEPS)}[step] AS step_name, count(*) AS users,
       CAST(median((reached_at - started_at) // 1000000) AS DOUBLE) AS median_seconds
FROM progress GROUP BY channel, step"""))
def q_funnel(spark, sf_dir):
    """Users and median time to each step of the funnel, by the channel that began it."""
    return funnel_by_channel(funnel_progress(models(spark, sf_dir).events))


# ---------------------------------------------------------------- stitched users
def signed_models(spark: SparkSession, sf_dir: str, stitched: bool = False) -> Models:
    """Models over events with logins; over stitched users on request."""
    m = models(spark, sf_dir)
    m.raw = with_logins(m.raw)
    if stitched:
        m.raw = stitch(m.raw, materialize(user_identity(m.raw), "user_identity"))
    return m


@register("user_identity", q("SELECT * FROM flat", flat=IDENTITY + """
SELECT user_pseudo_id, i.stitched_id, count(*) OVER (PARTITION BY i.stitched_id) AS devices, coalesce(accounts, 0) AS accounts
FROM identity i LEFT JOIN (SELECT stitched_id, count(DISTINCT user_id) AS accounts FROM links JOIN identity USING (user_pseudo_id)
                           GROUP BY stitched_id) a USING (stitched_id)"""))
def q_identity(spark, sf_dir):
    """Devices and the users that shared accounts make of them."""
    return user_identity(signed_models(spark, sf_dir).raw)


@register("marts_stitched", q("""
SELECT * RENAME (first_touch_to_conversion_days AS touch_to_conversion_days) FROM mart_first_click
UNION ALL BY NAME
SELECT * RENAME (last_touch_to_conversion_days AS touch_to_conversion_days) FROM mart_last_click""", flat=STITCHED))
def q_marts_stitched(spark, sf_dir):
    """Both marts over stitched users: a touch on one device is credited with a conversion on another."""
    m = signed_models(spark, sf_dir, stitched=True)
    both = [df.withColumnRenamed(f"{x}_touch_to_conversion_days", "touch_to_conversion_days")
            for x, df in (("first", m.first_click), ("last", m.last_click))]
    return ntz(both[0].unionByName(both[1]))


# ---------------------------------------------------------------- streaming
def _stream_rows(spark, sf_dir):
    return stream_rows_from_raw(raw_events(spark, sf_dir))


STREAM_COLS = ("event_id", "event_date", "event_timestamp", "event_name", "user_pseudo_id",
               "source", "medium", "ingestion_timestamp")


def _stream_view(df):
    return ntz(df.select("event_id", "event_date", "event_timestamp", "event_name", "user_pseudo_id",
                         F.col("traffic_source.source").alias("source"),
                         F.col("traffic_source.medium").alias("medium"), "ingestion_timestamp"))


def ingested(spark, sf_dir, indexed: bool = False) -> DataFrame:
    """A sink filled by the Structured Streaming ingest in two runs: the feed,
    then its resends with another stamp and a third of the feed once more."""
    base = new_scratch(spark, "stream-ingest")
    feed = _stream_rows(spark, sf_dir)
    src = f"{base}/incoming"
    for part in (feed, resends(feed).unionByName(feed.where(F.col("event_timestamp") % 3 == 0))):
        write_json_lines(part, src)
        ingest(spark, src, f"{base}/sink", f"{base}/checkpoint", f"{base}/dead_letter",
               ids=f"{base}/ids" if indexed else None)
    return read_event_table(spark, f"{base}/sink", STREAM_EVENT_SCHEMA)


@register("stream_ingest", q("SELECT * FROM stream_sink"))
def q_stream_ingest(spark, sf_dir):
    """What the sink holds after two runs of the streaming ingest (file source,
    availableNow, watermark + sink anti-join dedup)."""
    return _stream_view(ingested(spark, sf_dir))


@register("stream_ingest_indexed", q("SELECT * FROM stream_sink"))
def q_stream_ingest_indexed(spark, sf_dir):
    """The sink of the streaming ingest when an index of stored events by date says which dates to read."""
    return _stream_view(ingested(spark, sf_dir, indexed=True))


@register("recent_stream_events", q("""
SELECT event_id, event_name, user_pseudo_id, make_timestamp(event_timestamp) AS event_time,
       source, medium, ingestion_timestamp
FROM stream_sink ORDER BY ingestion_timestamp DESC, event_id LIMIT 20"""))
def q_recent_stream(spark, sf_dir):
    return ntz(serving.recent_stream_events(ingested(spark, sf_dir)))


@register("duplicate_event_ids", q("SELECT event_id, count(*) AS count FROM arrivals GROUP BY event_id HAVING count(*) > 1"))
def q_duplicates(spark, sf_dir):
    return serving.duplicate_event_ids(with_resends(_stream_rows(spark, sf_dir)))


@register("stream_health", q(f"""
SELECT count(*) AS total_events, count(DISTINCT user_pseudo_id) AS unique_users,
       max(ingestion_timestamp) AS last_event_time,
       date_sub('second', max(ingestion_timestamp), TIMESTAMP '{STREAM_AS_OF}') AS seconds_since_last
FROM stream_sink WHERE ingestion_timestamp >= TIMESTAMP '{STREAM_AS_OF}' - INTERVAL 1 HOUR"""))
def q_stream_health(spark, sf_dir):
    return ntz(serving.stream_health(ingested(spark, sf_dir), as_of=STREAM_AS_OF))


@register("ingest_latency", q("""
SELECT count(*) AS events,
       round(avg(epoch_us(ingestion_timestamp) - event_timestamp) / 1e6, 6) AS avg_latency_seconds,
       round(max(epoch_us(ingestion_timestamp) - event_timestamp) / 1e6, 6) AS max_latency_seconds,
       round(min(epoch_us(ingestion_timestamp) - event_timestamp) / 1e6, 6) AS min_latency_seconds
FROM stream_sink"""))
def q_latency(spark, sf_dir):
    sink = first_arrivals(with_resends(_stream_rows(spark, sf_dir)))
    return rounded(serving.ingest_latency(sink), (), ("avg_latency_seconds", "max_latency_seconds",
                                                       "min_latency_seconds"))


# ---------------------------------------------------------------- sessions, options
@register("sessions_by_gap", q("SELECT * FROM gap_sessions"))
def q_gap_sessions(spark, sf_dir):
    return ntz(gap_sessions(sessionize_by_gap(models(spark, sf_dir).events)))


@register("sessions_streamed", q("SELECT * FROM gap_sessions"))
def q_streamed_sessions(spark, sf_dir):
    """The sessions that a stream's stored changes lead to.  Every seventh event of the whole table
    arrives last, in a run of its own, days late for most, and corrects the sessions of the first run."""
    ensure_utc(spark)
    base = new_scratch(spark, "stream-sessions")
    raw = raw_events(spark, sf_dir)
    late = F.col("event_timestamp") % 7 == 0
    for part in (raw.where(~late | late.isNull()), raw.where(late)):
        part.write.mode("append").parquet(f"{base}/incoming")
        events = stage_events(spark.readStream.schema(RAW_EVENT_SCHEMA).parquet(f"{base}/incoming"),
                              AttributionConfig(as_of=RUN_AS_OF))
        store_session_changes(spark, events, f"{base}/changes", f"{base}/state")
    return ntz(current_sessions(spark.read.parquet(f"{base}/changes")))


@register("sessions_by_window", q("SELECT user_pseudo_id, session_day, session_start, session_end, events FROM gap_sessions"))
def q_window_sessions(spark, sf_dir):
    return ntz(sessions_by_window(models(spark, sf_dir).events))


@register("top_conversion_per_session", q("""
SELECT * EXCLUDE (rnk) FROM (
  SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY conversion_priority ASC,
         conversion_value DESC, conversion_timestamp ASC, conversion_id ASC) AS rnk
  FROM stg_conversions) WHERE conversion_event = 'purchase' OR rnk = 1"""))
def q_top_conversion(spark, sf_dir):
    return ntz(top_conversion_per_session(models(spark, sf_dir).conversions))


_ORACLE_CTE = {
    "stg_ga4_events": "stg_events", "stg_ga4_sessions": "stg_sessions",
    "stg_ga4_conversions": "stg_conversions", "int_touchpoints": "int_touchpoints",
    "int_user_journeys": "int_user_journeys", "mart_first_click_attribution": "mart_first_click",
    "mart_last_click_attribution": "mart_last_click",
    "mart_attribution_comparison": "mart_attribution_comparison",
}
ALL_CHECKS = MODEL_CHECKS + CUSTOM_CHECKS


@register("quality_checks", q(" UNION ALL ".join(oracle_check_sql(c, _ORACLE_CTE) for c in ALL_CHECKS)))
def q_quality(spark, sf_dir):
    m = models(spark, sf_dir)
    return run_checks(m.materialized_tables(checked_columns(ALL_CHECKS)), ALL_CHECKS)


@register("approx_unique_users", q("SELECT count(DISTINCT user_pseudo_id) AS exact_unique_users, true AS estimate_within_bound FROM stg_events"))
def q_approx_users(spark, sf_dir):
    return serving.approx_unique_users(models(spark, sf_dir).events)


_STORED_CHECKS = (
    Check("stg_ga4_events", "not_null", "traffic_source"), Check("stg_ga4_events", "accepted_values", "channel", ("Direct", "Organic Search")),
    Check("int_touchpoints", "unique", "touchpoint_date"), Check("int_touchpoints", "relationships", "channel", to_table="stg_ga4_conversions", to_column="conversion_channel"),
    Check("stg_ga4_conversions", "expression", "conversion_value", expr="conversion_value > 50"),
)


@register("failures_stored", q(" UNION ALL ".join(oracle_check_sql(c, _ORACLE_CTE) for c in _STORED_CHECKS)))
def q_failures_stored(spark, sf_dir):
    """Checks, most of which fail, counted from the failing keys and rows that one job stored."""
    m = models(spark, sf_dir)
    path = new_scratch(spark, "failures")
    store_failures({"stg_ga4_events": m.events, "int_touchpoints": m.touchpoints, "stg_ga4_conversions": m.conversions}, path, _STORED_CHECKS)
    names = spark.createDataFrame([(i, c.table, c.kind, c.column) for i, c in enumerate(_STORED_CHECKS)], "check int, table_name string, check_name string, column_name string")
    return count_failures(read_failures(spark, path).join(F.broadcast(names), ["table_name", "check_name", "column_name"]), _STORED_CHECKS)


@register("users_in_range_from_sketches", q("""
SELECT channel, count(DISTINCT user_pseudo_id) AS exact_users, true AS estimate_within_bound
FROM stg_events WHERE CAST(event_datetime AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
GROUP BY GROUPING SETS ((channel), ())"""))
def q_range_sketches(spark, sf_dir):
    """Users of a range of dates by channel and in all: stored sketches against the exact counts."""
    path = new_scratch(spark, "user-sketches")
    events = models(spark, sf_dir).events
    store_sketches(events, path)
    estimates = users_in_range(spark, path, "2024-01-05", "2024-01-20")
    exact = (events.where(F.to_date("event_datetime").between("2024-01-05", "2024-01-20")).groupingSets([["channel"], []], "channel")
             .agg(F.countDistinct("user_pseudo_id").alias("exact_users")))
    far = F.abs(F.col("estimated_users") - F.col("exact_users"))
    return (exact.alias("x").join(estimates.alias("e"), F.expr("x.channel <=> e.channel"), "left")
            .select("x.channel", "exact_users", F.coalesce(far <= F.greatest(F.lit(1.0), 3 * STANDARD_ERROR * F.col("exact_users")), F.lit(False)).alias("estimate_within_bound")))


@register("views_of_models", q("SELECT session_channel, count(*) AS sessions FROM stg_sessions GROUP BY session_channel"))
def q_views(spark, sf_dir):
    """Sessions by channel, from the models registered as views."""
    m = models(spark, sf_dir)
    register_views({"stg_ga4_sessions_view": m.sessions})
    return spark.sql("SELECT session_channel, count(*) AS sessions FROM stg_ga4_sessions_view GROUP BY session_channel")


# ---------------------------------------------------------------- written tables, read back
@register("events_in_shard_range", q("""
SELECT event_date, count(*) AS events FROM raw
WHERE event_date BETWEEN '20240105' AND '20240120' GROUP BY event_date"""))
def q_shard_range(spark, sf_dir):
    """Raw events stored by date, read by a shard range."""
    path = new_scratch(spark, "shards")
    raw = raw_events(spark, sf_dir).where("user_pseudo_id IS NOT NULL AND event_timestamp IS NOT NULL")
    write_clustered(raw, path, "event_date", ("event_timestamp",), mode="overwrite")
    shards = read_sharded_events(spark, path, "20240105", "20240120")
    return shards.groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))


@register("mart_written_and_restored", q("SELECT * FROM mart_first_click"))
def q_mart_restored(spark, sf_dir):
    """The written mart after its last date was exported, overwritten with
    other values, and restored."""
    path = new_scratch(spark, "mart")
    write_mart(models(spark, sf_dir).first_click, path)
    stored = spark.read.parquet(path)
    day = stored.agg(F.max("conversion_date")).first()[0]
    export = export_partition(spark, path, day, f"{path}-export")
    # What replaces the date comes from the export, not from the table it goes to.
    spoilt = spark.read.parquet(export).withColumns({"conversion_value": F.lit(-1.0), "conversion_date": F.lit(day)})
    write_incremental(spoilt.select(*stored.columns), path, "conversion_date")
    restore_partition(spark, export, path, day)
    return ntz(spark.read.parquet(path))


@register("events_retained", q(f"""
SELECT event_id, event_date FROM stream_sink
WHERE CAST(ingestion_timestamp AS DATE) >= CAST(TIMESTAMP '{STREAM_AS_OF}' AS DATE) - 7"""))
def q_retained(spark, sf_dir):
    """What retention keeps of the stored stream events."""
    path = new_scratch(spark, "stream-events")
    write_clustered(first_arrivals(with_resends(_stream_rows(spark, sf_dir))), path, "event_date", ("event_name", "user_pseudo_id"))
    return apply_retention(spark, path, f"{path}-kept", days=7, as_of=STREAM_AS_OF[:10]).select("event_id", "event_date")


@register("events_retained_in_place", q(f"""
SELECT event_id, event_date FROM stream_sink
WHERE CAST(ingestion_timestamp AS DATE) >= CAST(TIMESTAMP '{STREAM_AS_OF}' AS DATE) - 7"""))
def q_retained_in_place(spark, sf_dir):
    """The stored stream events after expired ones were deleted from the table itself."""
    path = new_scratch(spark, "stream-events")
    write_clustered(first_arrivals(with_resends(_stream_rows(spark, sf_dir))), path, "event_date", ("event_name", "user_pseudo_id"))
    retain_in_place(spark, path, days=7, as_of=STREAM_AS_OF[:10])
    return read_event_table(spark, path, STREAM_EVENT_SCHEMA).select("event_id", "event_date")


@register("dead_letters", q("""
SELECT 'malformed_json' AS reason, count(*) AS lines FROM stream_rows WHERE event_timestamp % 20 = 0
UNION ALL
SELECT 'missing_required_field', count(*) FROM stream_rows WHERE event_timestamp % 20 = 1"""))
def q_dead_letters(spark, sf_dir):
    """Lines that the ingest set aside; a part of the feed comes as broken lines, all alike."""
    base = new_scratch(spark, "dead-letters")
    feed = _stream_rows(spark, sf_dir)
    src = write_json_lines(feed, f"{base}/incoming")
    broken = feed.where("event_timestamp % 20 = 0").select(F.lit("{broken").alias("value"))
    lacking = feed.where("event_timestamp % 20 = 1").select(F.to_json(F.struct("event_id")).alias("value"))
    broken.union(lacking).write.mode("append").text(src)
    ingest(spark, src, f"{base}/sink", f"{base}/checkpoint", f"{base}/bad")
    reasons = spark.createDataFrame([("malformed_json",), ("missing_required_field",)], "reason string")
    counts = spark.read.schema("raw_line string, reason string, batch_id long").parquet(f"{base}/bad").groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))
    return reasons.join(counts, "reason", "left").select("reason", F.coalesce("lines", F.lit(0)).cast("long").alias("lines"))


@register("events_deduplicated", q("SELECT * FROM stg_events"))
def q_deduplicated(spark, sf_dir):
    """Staged events of a feed with repeats, each event once."""
    cfg = AttributionConfig(as_of=RUN_AS_OF, dedup_events=True)
    return ntz(replayed_models(spark, sf_dir, cfg=cfg).events)


# ---------------------------------------------------------------- refresh of all tables
LATE = "user_pseudo_id LIKE '%7' AND event_date BETWEEN '20240110' AND '20240112'"


def refreshed(spark: SparkSession, sf_dir: str) -> Generation:
    """All eight tables, built without the events of some users on three days and refreshed when those came in."""
    raw, cfg = models(spark, sf_dir).raw, AttributionConfig(as_of=RUN_AS_OF)
    root = new_scratch(spark, "refreshed")
    build_all(spark, root, raw.where(f"NOT coalesce({LATE}, false)"), cfg)
    refresh_all(spark, root, raw.where(LATE), cfg)
    return Generation(spark, root)


_REFRESHED = (*_COUNTED, ("stg_ga4_sessions", "stg_sessions"), ("mart_attribution_comparison", "mart_attribution_comparison"))


@register("refreshed_row_counts", q(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}" for name, cte in _REFRESHED)))
def q_refreshed_counts(spark, sf_dir):
    """Rows of the eight tables after late events were propagated through them."""
    g = refreshed(spark, sf_dir)
    short = {"mart_first_click": "mart_first_click_attribution", "mart_last_click": "mart_last_click_attribution"}
    return serving.model_row_counts({name: g.read(short.get(name, name)) for name, _ in _REFRESHED})


@register("refreshed_sessions", q("SELECT * REPLACE (round(session_revenue, 2) AS session_revenue) FROM stg_sessions"))
def q_refreshed_sessions(spark, sf_dir):
    return ntz(rounded(refreshed(spark, sf_dir).read("stg_ga4_sessions"), SESSION_CENTS))


@register("refreshed_journeys", q("SELECT * FROM int_user_journeys"))
def q_refreshed_journeys(spark, sf_dir):
    return ntz(refreshed(spark, sf_dir).read("int_user_journeys"))


@register("refreshed_comparison", q(_COMPARISON_OUT_SQL))
def q_refreshed_comparison(spark, sf_dir):
    """The comparison of both marts after late events."""
    return comparison_out(refreshed(spark, sf_dir).read("mart_attribution_comparison")).orderBy(F.desc("conversion_date"), "channel")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
