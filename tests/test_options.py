from builders import ev, raw_df
from touchline.config import AttributionConfig
from touchline.operators.staging import stage_conversions, stage_events, stage_sessions
from touchline.operators.touchpoints import touchpoints
from touchline.plans.models import Models


def test_batch_dedup_option(spark):
    # DOC-5: the same event delivered twice
    row = ev("u", "purchase", "2024-03-01 10:00:00", revenue=5.0)
    raw = raw_df(spark, [row, row])
    keep = AttributionConfig(as_of="2024-06-01 00:00:00")
    dedup = AttributionConfig(as_of="2024-06-01 00:00:00", dedup_events=True)
    assert stage_events(raw, keep).count() == 2
    assert stage_events(raw, dedup).count() == 1
    # T-6: without dedup the direct branch keeps both copies
    assert Models(raw, keep).first_click.count() == 2
    assert Models(raw, dedup).first_click.count() == 1


def test_negative_revenue_option(spark):
    # DOC-7
    rows = [ev("u", "purchase", "2024-03-01 10:00:00", revenue=-5.0),
            ev("v", "purchase", "2024-03-01 10:00:00", revenue=5.0)]
    raw = raw_df(spark, rows)
    cfg = AttributionConfig(as_of="2024-06-01 00:00:00", exclude_negative_revenue=True)
    events = stage_events(raw, cfg)
    assert [r.user_pseudo_id for r in stage_conversions(events, cfg).collect()] == ["v"]


def test_audit_columns(spark):
    # PRJ-6: load stamps are optional columns
    raw = raw_df(spark, [ev("u", "page_view", "2024-03-01 10:00:00")])
    cfg = AttributionConfig(as_of="2024-06-01 00:00:00")
    events = stage_events(raw, cfg, audit=True)
    assert "_loaded_at" in events.columns
    assert "_updated_at" in stage_sessions(events, audit=True).columns
    assert "_updated_at" in touchpoints(events, audit=True).columns
    assert "_loaded_at" not in stage_events(raw, cfg).columns


def test_custom_conversion_events_and_lookback(spark):
    # T-8 parameter: add_to_cart as a conversion; shorter lookback drops older touches
    rows = [ev("u", "page_view", "2024-03-01 10:00:00", source="email", medium="email", session=1),
            ev("u", "add_to_cart", "2024-03-05 10:00:00", session=2)]
    raw = raw_df(spark, rows)
    wide = AttributionConfig(as_of="2024-06-01 00:00:00", conversion_events=("add_to_cart",))
    (f,) = Models(raw, wide).first_click.collect()
    assert f.attributed_channel == "Email" and f.conversion_event == "add_to_cart"
    short = AttributionConfig(as_of="2024-06-01 00:00:00", conversion_events=("add_to_cart",), lookback_days=2)
    (g,) = Models(raw, short).first_click.collect()
    assert g.attributed_medium == "direct"


def test_cluster_conf_sizes_partitions():
    from touchline.session import cluster_conf
    conf = cluster_conf(100 * (1 << 40), executors=1000, cores_per_executor=8)
    # 100 TB at 256 MB per partition
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    small = cluster_conf(1 << 20, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_materialize_writes_under_checkpoint_dir(spark):
    from touchline.session import materialize
    base = spark.conf.get("spark.checkpoint.dir")
    df = materialize(spark.range(5), "probe")
    paths = df.inputFiles()
    assert paths and all(base in p for p in paths)
    assert df.count() == 5


def test_a_shared_checkpoint_folder_is_required_off_local_mode():
    import pytest

    from touchline.session import checkpoint_dir

    class Conf(dict):
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(Conf)
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session)


def test_a_projection_of_events_moves_no_rows(spark):
    from touchline.plans import registry
    plan = registry.QUERIES["stg_ga4_events"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_malformed_dates_raise(spark):
    import pytest

    from touchline.functions.timefns import yyyymmdd_to_date
    df = spark.createDataFrame([("20240131",), (None,)], "d string").select(yyyymmdd_to_date("d").alias("d"))
    assert [str(r.d) for r in df.collect()] == ["2024-01-31", "None"]
    bad = spark.createDataFrame([("2024-1-3",)], "d string").select(yyyymmdd_to_date("d"))
    with pytest.raises(Exception, match="not a yyyyMMdd date"):
        bad.collect()
