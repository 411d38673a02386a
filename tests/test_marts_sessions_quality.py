from datetime import date

from builders import ev, raw_df
from touchline.config import AttributionConfig
from touchline.operators.quality import MODEL_CHECKS, Check, run_checks, store_failures
from touchline.operators.sessionize import gap_sessions, sessionize_by_gap, sessions_by_window
from touchline.plans.models import Models

CFG = AttributionConfig(as_of="2024-06-01 00:00:00")


def test_comparison_one_sided_channel_day(spark):
    # H-17: a channel-day present in one mart only.
    rows = [ev("u", "page_view", "2024-03-01 09:00:00", source="email", medium="email", session=1),
            ev("u", "page_view", "2024-03-02 09:00:00", source="google", medium="organic", session=2),
            ev("u", "purchase", "2024-03-03 09:00:00", revenue=10.0, session=3)]
    m = Models(raw_df(spark, rows), CFG)
    cmp = {r.channel: r for r in m.comparison.collect()}
    assert cmp["Email"].first_click_conversions == 1 and cmp["Email"].last_click_conversions == 0
    assert cmp["Email"].avg_journey_days_lc is None and cmp["Email"].conversion_shift_percent == -100.0
    assert cmp["Organic Search"].first_click_conversions == 0
    assert cmp["Organic Search"].conversion_shift_percent is None  # first-click is 0
    assert cmp["Organic Search"].revenue_shift == 10.0


def test_gap_sessions_boundaries(spark):
    # H-23: 30 min apart -> same; 30 min + 1 s -> new; across midnight -> new.
    rows = [ev("a", "page_view", "2024-03-01 10:00:00"), ev("a", "page_view", "2024-03-01 10:30:00"),
            ev("b", "page_view", "2024-03-01 10:00:00"), ev("b", "page_view", "2024-03-01 10:30:01"),
            ev("c", "page_view", "2024-03-01 23:50:00"), ev("c", "page_view", "2024-03-02 00:05:00")]
    events = Models(raw_df(spark, rows), CFG).events
    s = gap_sessions(sessionize_by_gap(events)).collect()
    per_user = {}
    for r in s:
        per_user[r.user_pseudo_id] = per_user.get(r.user_pseudo_id, 0) + 1
    assert per_user == {"a": 1, "b": 2, "c": 2}
    w = sessions_by_window(events).collect()
    assert sorted((r.user_pseudo_id, r.events) for r in w) == sorted((r.user_pseudo_id, r.events) for r in s)


def test_quality_checks_flag_session_grain_duplicates(spark, scratch):
    rows = [ev("u", "page_view", "2024-03-01 09:00:00", source="email", medium="email", session=1),
            ev("u", "page_view", "2024-03-01 15:00:00", source="email", medium="email", session=2),
            ev("u", "page_view", "2024-03-01 16:00:00", no_session=True),
            ev("u", "purchase", "2024-03-02 09:00:00", revenue=10.0, session=3)]
    m = Models(raw_df(spark, rows), CFG)
    res = {(r.table_name, r.check_name, r.column_name): r.failures for r in run_checks(m.tables()).collect()}
    assert len(res) == len(MODEL_CHECKS) == 53
    assert res[("int_touchpoints", "unique", "touchpoint_id")] == 1  # T-1 expected failure
    assert res[("stg_ga4_events", "not_null", "session_id")] == 1     # H-13 / T-12
    assert res[("int_user_journeys", "relationships", "conversion_id")] == 0
    assert res[("stg_ga4_events", "accepted_values", "channel")] == 0
    bad = Check("stg_ga4_conversions", "expression", "conversion_value", expr="conversion_value > 100")
    (r,) = run_checks(m.tables(), [bad]).collect()
    assert r.failures == 1
    paths = store_failures(m.tables(), scratch, [Check("int_touchpoints", "unique", "touchpoint_id")])
    assert spark.read.parquet(paths[0]).count() == 1


def test_relationship_on_driver_tables(spark):
    from touchline.sources.scan import read_table
    sf = "/root/testdata/sf0.001"
    tables = {"orders": read_table(spark, sf, "orders"), "customer": read_table(spark, sf, "customer")}
    (r,) = run_checks(tables, [Check("orders", "relationships", "o_custkey", to_table="customer",
                                     to_column="c_custkey")]).collect()
    known = {x[0] for x in tables["customer"].select("c_custkey").collect()}
    assert r.failures == sum(x[0] is not None and x[0] not in known for x in tables["orders"].select("o_custkey").collect())


def test_checks_scan_each_table_once_and_store_rows(spark, scratch):
    from touchline.operators.quality import failing_keys, read_failures
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (None, None), (None, None), (9, "z")], "k int, v string")
    b = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    checks = [Check("a", "unique", "k"), Check("a", "not_null", "k"), Check("a", "not_null", "v"), Check("a", "accepted_values", "v", ("x",)),
              Check("a", "relationships", "k", to_table="b", to_column="id"), Check("b", "unique", "id"), Check("a", "expression", "k", expr="k < 5")]
    got = {(r.table_name, r.check_name, r.column_name): r.failures for r in run_checks({"a": a, "b": b}, checks).collect()}
    assert [got[c.table, c.kind, c.column] for c in checks] == [1, 2, 3, 2, 1, 1, 1]
    store_failures({"a": a, "b": b}, scratch, checks)
    stored = {(r.table_name, r.check_name, r.column_name, r.key, r.n_rows) for r in read_failures(spark, scratch).collect()}
    assert {("a", "unique", "k", "1", 2), ("a", "not_null", "k", "{}", 2), ("a", "relationships", "k", "9", 1), ("a", "expression", "k", '{"k":9,"v":"z"}', 1)} <= stored
    paths = []
    for name, df in (("a", a), ("b", b)):
        df.write.parquet(f"{scratch}-{name}")
        paths.append(spark.read.parquet(f"{scratch}-{name}"))
    plan = failing_keys(dict(zip("ab", paths)), checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_failures_of_one_check_are_written_by_many_tasks(spark, scratch):
    import glob

    from touchline.operators.quality import Check, store_failures
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c, v in zip(before, ("false", "-1")):
            spark.conf.set(c, v)
        store_failures({"t": spark.range(400)}, f"{scratch}/f", [Check("t", "expression", "id", expr="id < 0")])
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert len(glob.glob(f"{scratch}/f/table_name=t/check_name=expression/*.parquet")) > 1
    assert spark.read.parquet(f"{scratch}/f").count() == 400


def test_failing_row_becomes_json_once_for_all_checks(spark):
    from touchline.operators.quality import failing_keys
    df = spark.createDataFrame([(1, None, None, "x"), (2, None, "q", "y"), (3, "p", "q", "x")], "k int, u string, v string, w string")
    checks = [Check("a", "unique", "k"), Check("a", "not_null", "u"), Check("a", "not_null", "v"), Check("a", "not_null", "w"),
              Check("a", "expression", "k", expr="k > 1"), Check("a", "accepted_values", "w", ("x",))]
    failing = failing_keys({"a": df}, checks)
    assert {(r.check, r.key, r.n_rows) for r in failing.collect()} == {
        (1, '{"k":1,"w":"x"}', 1), (1, '{"k":2,"v":"q","w":"y"}', 1), (2, '{"k":1,"w":"x"}', 1), (4, '{"k":1,"w":"x"}', 1), (5, "y", 1)}
    execution = failing._jdf.queryExecution()
    assert execution.analyzed().toString().count("to_json") == 1
    assert execution.optimizedPlan().toString().count("AS _failing_row") == 1  # not copied into the checks


def test_row_counts_stage_the_events_once(spark, scratch):
    from touchline.plans import registry
    path, limit = f"{scratch}/sf/events.parquet", "spark.sql.codegen.hugeMethodLimit"
    spark.createDataFrame([(1, "2024-01-02 10:00:00", 7, "view", 1.0, '{"k": 1}'), (2, "2024-01-03 10:00:00", 7, "purchase", 5.0, '{"k": 4}'),
                           (3, "2024-01-04 10:00:00", 7, "purchase", 6.0, '{"k": 3}'), (4, "2024-01-04 10:00:00", None, "view", 6.0, None)],
                          "event_id long, ts string, user_id long, event_type string, value double, props string") \
        .selectExpr("event_id", "cast(ts as timestamp_ntz) ts", "user_id", "event_type", "value", "props").write.parquet(path)
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "65535")
        counts = registry.QUERIES["model_row_counts"](spark, f"{scratch}/sf")
        # Staging is too large a method to be compiled whole.
        assert int(spark.conf.get(limit)) <= 8000
    finally:
        spark.conf.set(limit, before)
    assert {r.table_name: r.row_count for r in counts.collect()} == {
        "stg_ga4_events": 3, "stg_ga4_conversions": 2, "int_touchpoints": 3, "int_user_journeys": 3, "mart_first_click": 2, "mart_last_click": 2}
    assert not [f for f in counts.inputFiles() if path in f]
