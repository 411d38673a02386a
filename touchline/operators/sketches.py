"""Distinct counts over any range of dates from stored sketches.

A HyperLogLog sketch of the users is kept for each (date, channel), beside the marts and partitioned like them.
Sketches of any dates and channels are merged without looking at events again; what a range costs grows
with its dates times channels, not with its events.  Late events replace the sketches of their dates only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sources.sinks import write_incremental

#: 2 ** 14 registers a sketch: a standard error of 1.04 / 2 ** 7.
LOG_REGISTERS = 14
STANDARD_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)
SKETCHES = "date date, channel string, users binary"


def user_sketches(events: DataFrame) -> DataFrame:
    """date, channel, users: a mergeable sketch of the users with staged events there.  Map-side partial sketches."""
    return events.groupBy(F.to_date("event_datetime").alias("date"), "channel").agg(
        F.hll_sketch_agg("user_pseudo_id", F.lit(LOG_REGISTERS)).alias("users"))


def store_sketches(events: DataFrame, path: str, dates: list | None = None) -> None:
    """Write the sketches of all dates of the events, or replace those of the given dates."""
    some = events if dates is None else events.where(F.to_date("event_datetime").isin(dates))
    write_incremental(user_sketches(some), path, "date")


def users_in_range(spark: SparkSession, path: str, first, last) -> DataFrame:
    """channel (null: all), estimated_users of the dates from first to last, from stored sketches alone.

    Dates without events give the row of all channels, with 0."""
    stored = spark.read.schema(SKETCHES).parquet(path).where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    by_channel = stored.groupBy("channel").agg(F.hll_union_agg("users").alias("users"))
    total = by_channel.agg(F.hll_union_agg("users").alias("users")).select(F.lit(None).cast("string").alias("channel"), "users")
    return by_channel.unionByName(total).select("channel", F.hll_sketch_estimate("users").alias("estimated_users"))
