"""Refresh the marts after new events arrive.

A new event on date ``d`` can change conversions dated ``d`` (if it is a
conversion) and the touchpoints of conversions dated ``d .. d+lookback``.
So only conversion dates ``[min d, max d + lookback]`` are recomputed, from
events dated ``[min d - lookback, max d + lookback]`` (a partition-pruned
read), and written with dynamic partition overwrite.  Late events are
therefore reprocessed, and untouched dates are left alone.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.config import DEFAULT_CONFIG, AttributionConfig
from touchline.plans.models import Models
from touchline.sources.sinks import write_incremental
from touchline.streaming.ingest import normalize_stream_events

MART_TABLES = ("first_click", "last_click")


def affected_dates(new_rows: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG):
    """(first, last) conversion date to rebuild, or None when empty (one
    tiny aggregate reaches the driver)."""
    r = new_rows.agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi")).first()
    if r is None or r["lo"] is None:
        return None
    return r["lo"], r["hi"] + timedelta(days=cfg.lookback_days)


def refresh_marts(spark: SparkSession, events_path: str, mart_root: str, new_rows: DataFrame,
                  cfg: AttributionConfig = DEFAULT_CONFIG) -> tuple | None:
    """Rebuild the first/last-click marts for the dates ``new_rows`` touch.

    ``events_path`` is the streamed event table (partitioned by DATE
    ``event_date``); marts go to ``mart_root/<name>`` partitioned by
    ``conversion_date``."""
    span = affected_dates(new_rows, cfg)
    if span is None:
        return None
    lo, hi = span
    read_lo = lo - timedelta(days=cfg.lookback_days)
    stored = spark.read.parquet(events_path).where(F.col("event_date").between(F.lit(read_lo), F.lit(hi)))
    models = Models(normalize_stream_events(stored), cfg)
    for name in MART_TABLES:
        mart = getattr(models, name).where(F.col("conversion_date").between(F.lit(lo), F.lit(hi)))
        write_incremental(mart, f"{mart_root}/{name}", "conversion_date", ("attributed_channel",))
    return lo, hi
