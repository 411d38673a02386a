import os
import random

from pyspark.sql import functions as F

from touchline.config import AttributionConfig
from touchline.operators.sessionize import gap_sessions, sessionize_by_gap
from touchline.operators.staging import stage_events
from touchline.plans.models import Models
from touchline.sources.schemas import RAW_EVENT_SCHEMA
from touchline.streaming.session_state import current_sessions, put_in, store_session_changes

from builders import ev, micros, raw_df

CFG = AttributionConfig(as_of="2030-01-01 00:00:00")


def drop_in(spark, scratch, rows, keep_minutes):
    """Another arrival for the stream in scratch; the stored changes after it."""
    src, sink = os.path.join(scratch, "in"), os.path.join(scratch, "changes")
    raw_df(spark, rows).coalesce(1).write.mode("append").parquet(src)
    events = stage_events(spark.readStream.schema(RAW_EVENT_SCHEMA).parquet(src), CFG)
    store_session_changes(spark, events, sink, os.path.join(scratch, "state"), keep_minutes=keep_minutes)
    return spark.read.parquet(sink)


def batch_sessions(spark, rows):
    return gap_sessions(sessionize_by_gap(Models(raw_df(spark, rows), CFG).events))


def same(got, want):
    got = got.select(*want.columns)
    return got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def at(times, user="u"):
    return [ev(user, "page_view", t) for t in times]


def test_intervals_merge_in_any_order():
    rng = random.Random(3)
    for _ in range(200):
        times = [rng.randrange(300) for _ in range(rng.randrange(1, 40))]
        sessions = []
        for t in times:
            put_in(sessions, t, t, 1, 10)
        want = []
        for t in sorted(times):
            if want and t - want[-1][1] <= 10:
                want[-1] = (want[-1][0], t, want[-1][2] + 1)
            else:
                want.append((t, t, 1))
        assert sessions == want


def test_late_events_bridge_and_correct_sessions(spark, scratch):
    early = at(["2024-03-01T10:00:00", "2024-03-01T11:00:00", "2024-03-01T23:50:00", "2024-03-02T00:05:00"])
    changes = drop_in(spark, scratch, early, keep_minutes=10_000)
    assert same(current_sessions(changes), batch_sessions(spark, early))
    assert {r["state"] for r in changes.collect()} == {"open"}  # open ones go out at once
    # 10:30 is exactly the timeout from both neighbours; days after, so far behind any watermark.
    late = at(["2024-03-09T09:00:00"]) + at(["2024-03-01T10:30:00", "2024-03-01T09:45:00"])
    changes = drop_in(spark, scratch, late, keep_minutes=10_000)
    assert same(current_sessions(changes), batch_sessions(spark, early + late))
    gone = [r["session_start"].strftime("%H:%M") for r in changes.collect() if r["state"] == "withdrawn"]
    assert sorted(gone) == ["10:00", "11:00"]


def test_sessions_stay_right_after_their_state_is_gone(spark, scratch):
    first = at(["2024-03-01T10:00:00", "2024-03-01T11:00:00"]) + at(["2024-03-01T10:00:00"], "v")
    drop_in(spark, scratch, first, keep_minutes=0)
    # Its batch is later than the timers of the first, which close all three sessions.
    second = at(["2024-03-05T10:00:00"], "w")
    changes = drop_in(spark, scratch, second, keep_minutes=0)
    assert changes.where("state = 'closed' AND user_pseudo_id IN ('u', 'v')").count() == 3
    third = at(["2024-03-01T10:20:00", "2024-03-01T10:40:00", "2024-03-01T12:00:00"])
    changes = drop_in(spark, scratch, third, keep_minutes=0)
    assert changes.where("user_pseudo_id = 'u'").select("epoch").distinct().count() == 2
    want = batch_sessions(spark, first + second + third)
    assert same(current_sessions(changes), want)
    assert want.where("user_pseudo_id = 'u'").count() == 2  # the epochs' intervals overlap and merge


def test_a_hot_user_reaches_the_state_as_intervals(spark):
    from touchline.streaming.session_state import intervals
    start = micros("2024-03-01T00:00:00")
    rows = spark.range(0, 50_000, 1, 1).select(
        F.lit("hot").alias("user_pseudo_id"), F.timestamp_micros(F.lit(start) + F.col("id") * 1_000_000).alias("event_datetime"))
    found = intervals(rows).collect()
    assert sum(r["events"] for r in found) == 50_000 and len(found) <= 10
    odd = rows.limit(1).select(F.lit(None).cast("string").alias("user_pseudo_id"), "event_datetime")
    assert intervals(odd).count() == 0 and intervals(rows.limit(0)).count() == 0


def test_users_of_a_day_share_their_state_and_timers(spark, scratch, monkeypatch):
    """Each bucket of users is one group of the stream; users close one by one."""
    from touchline.streaming import session_state
    monkeypatch.setattr(session_state, "BUCKETS", 2)
    rows = [e for n in range(60) for e in at(["2024-03-01T10:00:00", "2024-03-01T12:00:00"], f"u{n:02}")]
    changes = drop_in(spark, scratch, rows, keep_minutes=0.01)
    states = spark.read.format("statestore").option("stateVarName", "sessions").load(os.path.join(scratch, "state"))
    assert states.count() == 2
    # The users that come again stay open, the others of their bucket are closed in the same run.
    again = [e for n in range(0, 60, 3) for e in at(["2024-03-01T11:30:00"], f"u{n:02}")]
    changes = drop_in(spark, scratch, again, keep_minutes=0.01)
    closed = changes.where("state = 'closed'")
    assert closed.count() == 80 and closed.where("substr(user_pseudo_id, 2) % 3 = 0").isEmpty()
    changes = drop_in(spark, scratch, at(["2024-03-01T12:30:00"], "u01"), keep_minutes=0.01)
    assert changes.where("state = 'closed'").count() == 80 + 40
    assert same(current_sessions(changes), batch_sessions(spark, rows + again + at(["2024-03-01T12:30:00"], "u01")))
