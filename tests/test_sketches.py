import os

import pytest
from pyspark.sql import functions as F

from touchline.config import AttributionConfig
from touchline.operators.sketches import STANDARD_ERROR, store_sketches, users_in_range
from touchline.plans.models import Models
from touchline.sources.scan import raw_events


def test_ranges_are_merged_and_dates_are_replaced(spark, scratch):
    path = os.path.join(scratch, "sketches")
    events = Models(raw_events(spark, "/root/testdata/sf0.001"), AttributionConfig(as_of="2024-06-01 00:00:00")).events
    day = F.to_date("event_datetime")
    dates = [r[0] for r in events.select(day.alias("d")).distinct().orderBy("d").collect()]
    # The middle date is stored without most of its events first, then again with all.
    store_sketches(events.where((day != F.lit(dates[1])) | F.col("user_pseudo_id").endswith("1")), path)
    store_sketches(events, path, [dates[1]])
    for first, last in ((dates[0], dates[-1]), (dates[1], dates[1]), (dates[1], dates[3])):
        some = events.where(day.between(F.lit(first), F.lit(last)))
        exact = {r.channel: r.n for r in some.groupBy("channel").agg(F.countDistinct("user_pseudo_id").alias("n")).collect()}
        exact[None] = some.select("user_pseudo_id").distinct().count()
        got = {r.channel: r.estimated_users for r in users_in_range(spark, path, first, last).collect()}
        assert got == pytest.approx(exact, rel=3 * STANDARD_ERROR, abs=1)
    plan = users_in_range(spark, path, dates[0], dates[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "events" not in plan
    assert [tuple(r) for r in users_in_range(spark, path, "1999-01-01", "1999-01-02").collect()] == [(None, 0)]
