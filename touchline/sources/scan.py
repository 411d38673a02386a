"""Scans: driver tables, sharded raw events, model outputs."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sources.adapter import raw_events_from_driver
from touchline.sources.schemas import RAW_EVENT_SCHEMA

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw nested events derived from the driver ``events`` table.

    The table's timestamps are UTC wall-clock values, so the session time
    zone is pinned to UTC before they are converted."""
    from touchline.session import ensure_small_methods, ensure_utc
    ensure_utc(spark)
    ensure_small_methods(spark)
    return raw_events_from_driver(read_table(spark, sf_dir, "events"))


def read_sharded_events(spark: SparkSession, path: str, lo: str | None = None,
                        hi: str | None = None) -> DataFrame:
    """Raw events stored as a Parquet dataset partitioned by ``event_date``
    (``yyyyMMdd`` shards).  The shard range becomes a partition filter, so
    files outside it are not opened (their folders are still listed)."""
    df = (spark.read.schema(RAW_EVENT_SCHEMA)
          .option("basePath", path)
          .option("mergeSchema", "false")
          .parquet(path))
    if lo is not None:
        df = df.where(F.col("event_date") >= lo)
    if hi is not None:
        df = df.where(F.col("event_date") <= hi)
    return df
