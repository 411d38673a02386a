import os
from datetime import date

from pyspark.sql import functions as F

from touchline.config import AttributionConfig
from touchline.plans.models import Models
from touchline.sources.schemas import STREAM_EVENT_SCHEMA
from touchline.sources.scan import raw_events, read_sharded_events
from touchline.sources.sinks import (
    apply_retention, retain_in_place, ensure_event_table, export_partition, register_views, restore_partition,
    write_clustered, write_mart,
)
from touchline.streaming.ingest import first_arrivals, stream_rows_from_raw, with_resends
from touchline.streaming.refresh import refresh_marts

CFG = AttributionConfig(as_of="2024-06-01 00:00:00")
SF = "/root/testdata/sf0.001"


def test_sharded_scan_prunes_partitions(spark, scratch):
    raw = raw_events(spark, SF)
    path = os.path.join(scratch, "raw")
    write_clustered(raw, path, "event_date", ("event_name", "user_pseudo_id"), mode="overwrite")
    df = read_sharded_events(spark, path, "20240105", "20240110")
    # Files of dates out of the range aren't opened: one of them may be damaged.
    out = os.path.join(path, "event_date=20240120")
    for f in os.listdir(out):
        os.remove(os.path.join(out, f))
    with open(os.path.join(out, "part-0.parquet"), "wb") as f:
        f.write(b"damaged")
    assert df.count() == raw.where(F.col("event_date").between("20240105", "20240110")).count()
    assert Models(df, CFG).events.count() == df.count()


def test_incremental_refresh_equals_full(spark, scratch):
    rows = first_arrivals(with_resends(stream_rows_from_raw(raw_events(spark, SF))))
    events_path = os.path.join(scratch, "events")
    assert ensure_event_table(spark, events_path, STREAM_EVENT_SCHEMA)
    assert not ensure_event_table(spark, events_path, STREAM_EVENT_SCHEMA)
    early = rows.where(F.col("event_date") < F.lit(date(2024, 1, 20)))
    late = rows.where(F.col("event_date") >= F.lit(date(2024, 1, 20)))
    marts = os.path.join(scratch, "marts")
    write_clustered(early, events_path, "event_date", ("event_name",))
    refresh_marts(spark, events_path, marts, early, CFG)
    write_clustered(late, events_path, "event_date", ("event_name",))
    span = refresh_marts(spark, events_path, marts, late, CFG)
    assert span[0] == date(2024, 1, 20)
    from touchline.streaming.ingest import normalize_stream_events
    full = Models(normalize_stream_events(spark.read.parquet(events_path)), CFG)
    for name in ("first_click", "last_click"):
        inc = spark.read.parquet(os.path.join(marts, name)).select(*getattr(full, name).columns)
        ref = getattr(full, name)
        assert inc.exceptAll(ref).count() == 0 and ref.exceptAll(inc).count() == 0


def test_export_restore_and_retention(spark, scratch):
    m = Models(raw_events(spark, SF), CFG)
    mart = os.path.join(scratch, "mart")
    write_mart(m.first_click, mart)
    day = m.first_click.agg(F.max("conversion_date")).first()[0]
    before = spark.read.parquet(mart).where(F.col("conversion_date") == F.lit(day)).count()
    exp = export_partition(spark, mart, day, os.path.join(scratch, "export"))
    assert spark.read.parquet(exp).count() == before
    restore_partition(spark, exp, mart, day)
    assert spark.read.parquet(mart).count() == m.first_click.count()
    register_views({"mart_first": m.first_click})
    assert spark.sql("SELECT count(*) FROM mart_first").first()[0] == m.first_click.count()
    rows = stream_rows_from_raw(raw_events(spark, SF))
    src = os.path.join(scratch, "stream")
    write_clustered(rows, src, "event_date", ("event_name",), mode="overwrite")
    kept = apply_retention(spark, src, os.path.join(scratch, "kept"), days=7, as_of="2024-01-31")
    assert kept.count() == rows.where(F.to_date("ingestion_timestamp") >= F.lit(date(2024, 1, 24))).count()


def test_retention_in_place(spark, scratch):
    """Expired dates go, a date with some expired rows is rewritten, all other files stay as they are."""
    days = [(f"2024-01-{d:02d}", f"2024-01-{s:02d} 10:00:00", f"{d}-{s}") for d in range(1, 11) for s in (d, d + 1)]
    rows = spark.createDataFrame(days + [("2024-01-02", None, "no stamp")], "event_date string, at string, id string")
    rows = rows.selectExpr("cast(event_date as date) event_date", "cast(at as timestamp) ingestion_timestamp", "id")
    path = os.path.join(scratch, "events")
    write_clustered(rows, path, "event_date", ("id",))
    files = lambda: {os.path.join(b, f): os.path.getmtime(os.path.join(b, f)) for b, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files()
    done = retain_in_place(spark, path, days=3, as_of="2024-01-10")
    assert done == {"dropped": ["2024-01-01", "2024-01-03", "2024-01-04", "2024-01-05"], "rewritten": ["2024-01-02", "2024-01-06"]}
    got = {r.id for r in spark.read.parquet(path).collect()}
    assert got == {r.id for r in rows.where("ingestion_timestamp is null or to_date(ingestion_timestamp) >= '2024-01-07'").collect()}
    late = {f: t for f, t in before.items() if any(f"event_date=2024-01-{d:02d}" in f for d in range(7, 11))}
    assert late and all(files().get(f) == t for f, t in late.items()) and len(files()) < len(before)
    assert retain_in_place(spark, path, days=3, as_of="2024-01-10") == {"dropped": [], "rewritten": []}


def test_stream_ingest_with_refresh_handles_late_events(spark, scratch):
    """Ingest with the mart-refresh callback; a later file carries events for
    early dates (late arrivals).  The incrementally refreshed marts must
    equal a full recompute over everything stored."""
    from touchline.streaming.ingest import ingest, normalize_stream_events, write_json_lines
    rows = stream_rows_from_raw(raw_events(spark, SF))
    cut = F.lit(date(2024, 1, 10))
    on_time = rows.where((F.col("event_date") >= cut) | (F.col("event_timestamp") % 3 != 0))
    late = rows.where((F.col("event_date") < cut) & (F.col("event_timestamp") % 3 == 0)) \
        .withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + F.expr("INTERVAL 20 DAYS"))
    src, sink, ck, marts = (os.path.join(scratch, x) for x in ("src", "sink", "ck", "marts"))

    def refresh(sp, new_rows):
        refresh_marts(sp, sink, marts, new_rows, CFG)

    write_json_lines(on_time, src)
    r1 = ingest(spark, src, sink, ck, refresh=refresh)
    write_json_lines(late, src)
    r2 = ingest(spark, src, sink, ck, refresh=refresh)
    assert r1.success and r2.success
    assert r1.rows_inserted + r2.rows_inserted == rows.count()
    full = Models(normalize_stream_events(spark.read.parquet(sink)), CFG)
    for name in ("first_click", "last_click"):
        inc = spark.read.parquet(os.path.join(marts, name)).select(*getattr(full, name).columns)
        ref = getattr(full, name)
        assert inc.exceptAll(ref).count() == 0 and ref.exceptAll(inc).count() == 0


def test_one_hot_date_is_written_by_many_tasks(spark, scratch):
    path = os.path.join(scratch, "hot")
    df = spark.range(400_000).select(F.lit("2024-01-01").cast("date").alias("event_date"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        write_clustered(df.repartition(8), path, "event_date", ("x",))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    out = spark.read.parquet(path)
    assert len(out.inputFiles()) > 1 and out.count() == 400_000


def test_created_table_is_readable_before_the_first_row(spark, scratch):
    from touchline.sources.sinks import read_event_table
    path = os.path.join(scratch, "fresh")
    assert ensure_event_table(spark, path, STREAM_EVENT_SCHEMA)
    assert read_event_table(spark, path, STREAM_EVENT_SCHEMA).count() == 0
