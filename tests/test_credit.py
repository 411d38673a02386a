import pytest

from touchline.config import AttributionConfig
from touchline.operators.attribution import linear_credit
from touchline.operators.credit import credit_by_channel, journey_shares
from touchline.plans import registry
from touchline.plans.models import Models
from touchline.sources.scan import raw_events
from tests.builders import ev, raw_df

CFG = AttributionConfig(as_of="2030-01-01 00:00:00")
SOURCES = {"Email": ("x", "email"), "Referral": ("x", "referral"), "Affiliate": ("x", "affiliate")}


def model(spark, touches, conversions, **kw):
    rows = [ev("u", "page_view", at, *SOURCES[c], session=i) for i, (c, at) in enumerate(touches)]
    rows += [ev("u", "purchase", at, *SOURCES["Email"], revenue=v, session=900) for at, v in conversions]
    return Models(raw_df(spark, rows), CFG, **kw)


def shares(m, half_life=None):
    return {r.channel: r.share for r in journey_shares(m.conversions, m.touchpoints, 14, half_life).collect()}


def test_half_life(spark):
    m = model(spark, [("Email", "2024-03-01 12:00:00"), ("Referral", "2024-03-08 12:00:00"), ("Affiliate", "2024-03-15 12:00:00")],
              [("2024-03-15 12:00:00", 70.0)])
    # At the window's start and strictly before the conversion: two touches, a week apart.
    got = shares(m, 7)
    assert got.keys() == {"Email", "Referral"}
    assert got["Email"] == pytest.approx(1 / 3) and got["Referral"] == pytest.approx(2 / 3)
    assert shares(m) == {"Email": 0.5, "Referral": 0.5}


def test_years_and_short_half_lives_stay_exact(spark):
    touches = [("Email", f"{y}-06-01 00:00:01") for y in range(2020, 2029)] + [("Referral", f"{y}-06-10 00:00:00") for y in range(2020, 2029)]
    m = model(spark, touches, [(f"{y}-06-11 00:00:00", 10.0) for y in range(2020, 2029)])
    rows = journey_shares(m.conversions, m.touchpoints, 14, 0.25).collect()
    assert len(rows) == 18
    for r in rows:
        want = 2.0 ** (-4 * (9 - 1 / 86400)) if r.channel == "Email" else 1.0
        assert r.share == pytest.approx(want, rel=1e-6)


def test_shares_sum_to_one_and_credit_to_the_value(spark):
    m = registry.models(spark, "/root/testdata/sf0.001")
    touched = {r.conversion_id: r.v for r in m.journeys.selectExpr("conversion_id", "conversion_value v").distinct().collect()}
    for half_life in (None, 0.5, 7):
        found = journey_shares(m.conversions, m.touchpoints, 14, half_life)
        total = {r.conversion_id: r.s for r in found.groupBy("conversion_id").sum("share").withColumnRenamed("sum(share)", "s").collect()}
        assert total.keys() == touched.keys() and all(abs(s - 1) < 1e-9 for s in total.values())
        assert sum(r.total_attributed_value for r in credit_by_channel(found).collect()) == pytest.approx(sum(touched.values()))


def test_linear_equals_the_journeys_with_repeated_conversions(spark):
    raw = raw_events(spark, "/root/testdata/sf0.001")
    m = Models(raw.unionByName(raw.where("event_timestamp % 10 = 0")), CFG)
    by_pairs = {r.channel: r.total_attributed_value for r in linear_credit(m.journeys).collect()}
    by_counts = {r.channel: r.total_attributed_value for r in m.linear().collect()}
    assert by_counts == pytest.approx(by_pairs)


def test_no_pairs_in_the_plan(spark):
    m = registry.models(spark, "/root/testdata/sf0.001")
    plan = m.time_decay(7)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join" in line]
    assert joins and all("<" not in line.replace("<=>", "") and ">" not in line.replace("<=>", "") for line in joins)
    assert "attribution_window_end" not in "".join(joins)


def test_an_unknown_channel_is_an_error(spark):
    m = model(spark, [("Email", "2024-03-01 12:00:00")], [("2024-03-02 12:00:00", 1.0)])
    with pytest.raises(Exception, match="not a known channel"):
        journey_shares(m.conversions, m.touchpoints, 14, 7, channels=("Referral",)).collect()
    with pytest.raises(ValueError):
        journey_shares(m.conversions, m.touchpoints, 14, 0)


def test_nothing(spark):
    m = model(spark, [], [("2024-03-02 12:00:00", 1.0)])
    assert journey_shares(m.conversions, m.touchpoints, 14, 7).collect() == []
    assert journey_shares(m.conversions.limit(0), m.touchpoints, 14, 7).collect() == []
