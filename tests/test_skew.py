"""A user holding a third of all rows: the ranked journey plan gives the
same rows as the windowed one and never windows over a whole journey."""

from datetime import datetime, timedelta, timezone

from builders import ev, raw_df
from touchline.config import AttributionConfig
from touchline.plans.models import Models

CFG = AttributionConfig(as_of="2024-06-01 00:00:00")
CHANNELS = [("google", "organic"), ("email", "email"), ("facebook", "cpc"), ("(direct)", "(none)")]


def rows():
    out = []
    t0 = datetime(2024, 3, 1, tzinfo=timezone.utc)
    # hot user: 600 events over 20 days, purchases every 23rd event
    for i in range(600):
        t = t0 + timedelta(minutes=47 * i)
        name = "purchase" if i % 23 == 22 else "page_view"
        s, m = CHANNELS[i % 4]
        out.append(ev("hot", name, t.strftime("%Y-%m-%d %H:%M:%S"), source=s, medium=m,
                      session=i // 9, revenue=float(i) if name == "purchase" else None))
    # 60 light users, 20 events each
    for u in range(60):
        for i in range(20):
            t = t0 + timedelta(hours=13 * i + u)
            name = "purchase" if i % 7 == 6 else "page_view"
            s, m = CHANNELS[(i + u) % 4]
            out.append(ev(f"u{u}", name, t.strftime("%Y-%m-%d %H:%M:%S"), source=s, medium=m,
                          session=i // 3, revenue=1.0 if name == "purchase" else None))
    return out


def test_ranked_equals_windowed_on_skewed_user(spark):
    raw = raw_df(spark, rows())
    ranked = Models(raw, CFG).journeys
    windowed = Models(raw, CFG, journey_plan="windowed").journeys
    assert ranked.count() > 0
    assert ranked.exceptAll(windowed).count() == 0 and windowed.exceptAll(ranked).count() == 0
    hot = ranked.where("user_pseudo_id = 'hot'").agg({"total_touchpoints": "max"}).first()[0]
    assert hot > 20
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    # no window whose only partition key is the conversion id
    assert "windowspecdefinition(conversion_id" not in plan


def test_marts_equal_on_skewed_user(spark):
    raw = raw_df(spark, rows())
    a = Models(raw, CFG)
    b = Models(raw, CFG, mart_plan="windowed", journey_plan="windowed")
    for name in ("first_click", "last_click"):
        x, y = getattr(a, name), getattr(b, name)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_gap_sessions_independent_of_bucket_width(spark):
    from touchline.operators.sessionize import sessionize_by_gap
    t = datetime(2024, 3, 1, 20, 0, tzinfo=timezone.utc)
    mixed = []
    for i in range(400):  # gaps of 1..41 minutes (some exactly 30), across hours and midnights
        t += timedelta(minutes=(i * 7) % 41 + 1)
        mixed.append(ev("g", "page_view", t.strftime("%Y-%m-%d %H:%M:%S")))
    events = Models(raw_df(spark, rows() + mixed), CFG).events
    base = sessionize_by_gap(events, bucket_minutes=1440)
    assert 1 < base.where("user_pseudo_id = 'g'").select("gap_session_id").distinct().count() < 400
    for minutes in (5, 60):
        other = sessionize_by_gap(events, bucket_minutes=minutes)
        assert base.exceptAll(other).count() == 0 and other.exceptAll(base).count() == 0
