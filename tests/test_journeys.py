from builders import ev, raw_df
from touchline.config import AttributionConfig
from touchline.plans.models import Models

CFG = AttributionConfig(as_of="2024-06-01 00:00:00")


def build(spark, rows, **kw):
    return Models(raw_df(spark, rows), kw.pop("cfg", CFG), **kw)


def marts(spark, rows):
    m = build(spark, rows)
    first = {r.conversion_id: r for r in m.first_click.collect()}
    last = {r.conversion_id: r for r in m.last_click.collect()}
    return m, first, last


def test_single_touch(spark):
    # H-1
    rows = [ev("u", "page_view", "2024-03-01 10:00:00", source="email", medium="email"),
            ev("u", "purchase", "2024-03-02 10:00:00", source="(direct)", medium="(none)", revenue=50.0, session=2)]
    m, first, last = marts(spark, rows)
    (f,), (l,) = first.values(), last.values()
    assert f.attributed_channel == l.attributed_channel == "Email"
    assert f.journey_type == "Single Touch" and f.total_touchpoints == 1


def test_worked_example(spark):
    # H-2: organic day 1, paid social day 3, email day 5, direct purchase day 7 in one event.
    rows = [
        ev("u", "page_view", "2024-03-01 09:00:00", source="google", medium="organic", session=1),
        ev("u", "page_view", "2024-03-03 09:00:00", source="facebook", medium="cpc", session=2),
        ev("u", "page_view", "2024-03-05 09:00:00", source="email", medium="email", session=3),
        ev("u", "purchase", "2024-03-07 09:00:00", source="(direct)", medium="(none)", session=4, revenue=100.0),
    ]
    m, first, last = marts(spark, rows)
    (f,), (l,) = first.values(), last.values()
    assert (f.attributed_channel, f.conversion_value) == ("Organic Search", 100.0)
    assert (l.attributed_channel, l.conversion_value) == ("Email", 100.0)
    assert f.total_touchpoints == 3 and f.journey_length_days == 6


def test_direct_view_before_purchase_becomes_last(spark):
    # H-2b / T-4: the conversion's own session group counts when it starts earlier.
    rows = [
        ev("u", "page_view", "2024-03-01 09:00:00", source="google", medium="organic", session=1),
        ev("u", "page_view", "2024-03-07 08:59:00", source="(direct)", medium="(none)", session=4),
        ev("u", "purchase", "2024-03-07 09:00:00", source="(direct)", medium="(none)", session=4, revenue=100.0),
    ]
    _, first, last = marts(spark, rows)
    assert next(iter(last.values())).attributed_channel == "Direct"
    assert next(iter(first.values())).attributed_channel == "Organic Search"


def test_two_purchases_independent(spark):
    # H-3
    rows = [ev("u", "page_view", "2024-03-01 09:00:00", source="email", medium="email"),
            ev("u", "purchase", "2024-03-02 09:00:00", revenue=1.0, session=2),
            ev("u", "purchase", "2024-03-05 09:00:00", revenue=2.0, session=3)]
    m, first, _ = marts(spark, rows)
    assert len(first) == 2
    j = m.journeys.collect()
    assert {r.conversion_id for r in j} == set(first)


def test_page_views_only(spark):
    # H-4
    rows = [ev("u", "page_view", "2024-03-01 09:00:00")]
    m, first, last = marts(spark, rows)
    assert not first and not last and m.journeys.count() == 0


def test_no_prior_touch_is_direct_branch(spark):
    # H-5 / T-7
    rows = [ev("u", "purchase", "2024-03-01 09:00:00", source="email", medium="email", revenue=5.0)]
    _, first, _ = marts(spark, rows)
    (f,) = first.values()
    assert f.attributed_medium == "direct" and f.attributed_channel == "Email"
    assert f.total_touchpoints == 1 and f.journey_length_days == 0 and f.first_touch_to_conversion_days == 0
    assert f.attributed_campaign is None


def test_window_edges(spark):
    # H-6: exactly 14 days before is kept, 14 days + 1 us is not; H-7: same instant excluded.
    conv = "2024-03-20 12:00:00.000000"
    rows = [
        ev("u", "page_view", "2024-03-06 12:00:00.000000", source="email", medium="email", session=1),
        ev("v", "page_view", "2024-03-06 11:59:59.999999", source="email", medium="email", session=1),
        ev("u", "purchase", conv, revenue=1.0, session=9),
        ev("v", "purchase", conv, revenue=1.0, session=9),
    ]
    m = build(spark, rows)
    j = m.journeys.collect()
    users = sorted(r.user_pseudo_id for r in j)
    assert users == ["u"]  # the purchase's own group starts at the conversion: excluded
    assert j[0].days_to_conversion == 14


def test_session_grain_repeats_ids_channel_day_does_not(spark):
    # H-8 / T-1
    rows = [ev("u", "page_view", "2024-03-01 09:00:00", source="email", medium="email", session=1),
            ev("u", "page_view", "2024-03-01 15:00:00", source="email", medium="email", session=2)]
    tp = build(spark, rows).touchpoints.collect()
    assert len(tp) == 2 and tp[0].touchpoint_id == tp[1].touchpoint_id
    cd = build(spark, rows, cfg=AttributionConfig(as_of="2024-06-01 00:00:00", touchpoint_grain="channel_day"))
    (one,) = cd.touchpoints.collect()
    assert one.touchpoint_event_count == 2


def test_group_starting_before_window_dropped(spark):
    # H-11 / T-3
    rows = [ev("u", "page_view", "2024-03-05 23:00:00", source="email", medium="email", session=1),
            ev("u", "page_view", "2024-03-05 23:50:00", source="email", medium="email", session=1),
            ev("u", "purchase", "2024-03-19 23:30:00", revenue=1.0, session=5)]
    assert build(spark, rows).journeys.count() == 0


def test_equal_timestamps_stable_order(spark):
    # H-12 / DOC-2: ties order by traffic source.
    rows = [ev("u", "page_view", "2024-03-01 09:00:00", source="zeta", medium="referral", session=1),
            ev("u", "page_view", "2024-03-01 09:00:00", source="alpha", medium="referral", session=2),
            ev("u", "purchase", "2024-03-02 09:00:00", revenue=1.0, session=3)]
    for plan in ("single_pass", "windowed"):
        m = build(spark, rows, mart_plan=plan)
        assert m.first_click.collect()[0].attributed_source == "alpha"
        assert m.last_click.collect()[0].attributed_source == "zeta"


def test_elapsed_units_truncate(spark):
    # H-15: 47 h -> 1 day, 47 hours.
    rows = [ev("u", "page_view", "2024-03-01 09:00:00", source="email", medium="email", session=1),
            ev("u", "purchase", "2024-03-03 08:00:00", revenue=1.0, session=2)]
    (j,) = build(spark, rows).journeys.collect()
    assert (j.days_to_conversion, j.hours_to_conversion) == (1, 47)


def test_journey_type_labels(spark):
    # H-24: 1, 2, 3, 5, 6, 10, 11 touches.
    want = {1: "Single Touch", 2: "Two Touch", 3: "Short Journey (3-5)", 5: "Short Journey (3-5)",
            6: "Medium Journey (6-10)", 10: "Medium Journey (6-10)", 11: "Long Journey (10+)"}
    rows = []
    for n in want:
        u = f"u{n}"
        for i in range(n):
            rows.append(ev(u, "page_view", f"2024-03-10 0{i // 6}:{(i % 6) * 10:02d}:00", source=f"s{i}",
                           medium="referral", session=1))
        rows.append(ev(u, "purchase", "2024-03-11 09:00:00", revenue=1.0, session=2))
    first = build(spark, rows).first_click.collect()
    got = {int(r.user_pseudo_id[1:]): (r.total_touchpoints, r.journey_type) for r in first}
    assert got == {n: (n, label) for n, label in want.items()}


def test_plans_agree_and_invariants(spark):
    from touchline.sources.scan import raw_events
    m = Models(raw_events(spark, "/root/testdata/sf0.001"), CFG)
    w = Models(raw_events(spark, "/root/testdata/sf0.001"), CFG, mart_plan="windowed")
    for name in ("first_click", "last_click"):
        a, b = getattr(m, name), getattr(w, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # every conversion exactly once per mart; totals equal (T-11)
    n = m.conversions.count()
    assert m.first_click.select("conversion_id").distinct().count() == n == m.first_click.count()
    s = {r.model: r for r in __import__("touchline.plans.serving", fromlist=["x"]).attribution_summary(
        m.first_click, m.last_click).collect()}
    assert s["First-Click"].conversions == s["Last-Click"].conversions
    assert abs(s["First-Click"].revenue - s["Last-Click"].revenue) < 1e-6
    # linear credit sums to the attributed conversions' value
    from pyspark.sql import functions as F
    lin = m.linear().agg(F.sum("total_attributed_value")).first()[0]
    touched = m.journeys.select("conversion_id", "conversion_value").distinct().agg(F.sum("conversion_value")).first()[0]
    assert abs(lin - touched) < 1e-6
    # bucket width does not change the pairs
    one = Models(raw_events(spark, "/root/testdata/sf0.001"), CFG, bucket_days=1).journeys
    wide = Models(raw_events(spark, "/root/testdata/sf0.001"), CFG, bucket_days=400).journeys
    assert one.exceptAll(wide).count() == 0 and wide.exceptAll(one).count() == 0


def test_replayed_conversions_have_one_attributed_row(spark):
    rows = [
        ev("u", "page_view", "2024-03-01 09:00:00", source="google", medium="organic", session=1),
        ev("u", "page_view", "2024-03-03 09:00:00", source="facebook", medium="cpc", session=2),
        ev("u", "purchase", "2024-03-05 09:00:00", source="email", medium="email", revenue=10.0, session=3),
        ev("u", "purchase", "2024-03-05 09:00:00", source="email", medium="email", revenue=10.0, session=3),
    ]
    raw = raw_df(spark, rows)
    for kw in ({}, {"mart_summary": "struct"}, {"mart_plan": "windowed", "journey_plan": "windowed"}, {"mart_plan": "windowed"}):
        m = Models(raw, CFG, **kw)
        positions = sorted((r.touchpoint_position, r.is_first_touchpoint, r.is_last_touchpoint, r.total_touchpoints) for r in m.journeys.collect())
        n = len(positions)
        assert [p[0] for p in positions] == list(range(1, n + 1)) and {p[3] for p in positions} == {n}
        assert [p[1] for p in positions] == [True] + [False] * (n - 1) and [p[2] for p in positions] == [False] * (n - 1) + [True]
        first, last = m.first_click.collect(), m.last_click.collect()
        assert len(first) == len(last) == 1
        assert first[0].attributed_channel == "Organic Search" and first[0].total_touchpoints == n
        comparison = m.comparison.collect()
        assert sum(r.first_click_revenue for r in comparison) == sum(r.last_click_revenue for r in comparison) == 10.0


def exchanged_columns(df):
    """Names of the columns of every exchange in a plan (without AQE: the plan as it would run)."""
    return [{a.name() for a in _scala(node.output())} for node in _nodes(df._jdf.queryExecution().executedPlan())
            if node.nodeName().startswith("Exchange")]


def _scala(seq):
    return [seq.apply(i) for i in range(seq.size())]


def _nodes(plan):
    yield plan
    for child in _scala(plan.children()):
        yield from _nodes(child)


def test_pairs_are_not_shuffled_with_both_sides(spark):
    # Every touch is within a journey of many conversions: wide pairs in an exchange grow far beyond the input.
    from touchline.sources.scan import raw_events
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c, v in zip(before, ("false", "-1")):
            spark.conf.set(c, v)
        raw = raw_events(spark, "/root/testdata/sf0.001")
        for plan in ("ranked", "windowed"):
            moved = exchanged_columns(Models(raw, CFG, journey_plan=plan).journeys)
            assert moved and not [x for x in moved if {"touchpoint_id", "conversion_value"} <= x], plan
            if plan == "ranked":
                assert not [x for x in moved if {"touchpoint_id", "conversion_id"} <= x]
        for model in ("first_click", "last_click"):
            m = Models(raw, CFG, mart_plan="windowed", journey_plan="windowed")
            # Pairs are formed once: one exchange of touches by day bucket.
            assert len([x for x in exchanged_columns(getattr(m, model)) if {"_t_user", "_bucket"} <= x]) == 1
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_journeys_over_several_rank_slices(spark):
    # 700 touches of one user, a conversion amid them and two at the end, one of them twice.
    rows = [ev("u", "page_view", f"2024-03-{1 + i // 60:02d} {i % 60 // 3:02d}:{i % 3 * 20:02d}:00", source=f"s{i}", medium="referral", session=i) for i in range(700)]
    rows += [ev("u", "purchase", "2024-03-06 09:10:00", revenue=1.0, session=9001), ev("u", "purchase", "2024-03-12 23:00:00", revenue=2.0, session=9002)]
    rows += [ev("u", "begin_checkout", "2024-03-12 23:00:00", value=3, session=9003)] * 2
    ranked, windowed = build(spark, rows).journeys, build(spark, rows, journey_plan="windowed").journeys
    assert ranked.count() > 2000
    assert ranked.exceptAll(windowed).count() == 0 and windowed.exceptAll(ranked).count() == 0
