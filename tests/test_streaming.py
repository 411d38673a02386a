import os

import pytest
from pyspark.sql import functions as F

from touchline.sources.scan import raw_events
from touchline.streaming.ingest import (
    first_arrivals, ingest, normalize_stream_events, stream_rows_from_raw, verify_deduplication,
    with_resends, write_json_lines,
)


def _ten(spark):
    rows = stream_rows_from_raw(raw_events(spark, "/root/testdata/sf0.001"))
    return rows.orderBy("event_id").limit(10).persist()


def test_replay_and_late_resend_and_dead_letters(spark, scratch):
    ten = _ten(spark)
    src, sink, ck, dl = (os.path.join(scratch, x) for x in ("src", "sink", "ck", "dl"))
    write_json_lines(ten, src)
    r1 = ingest(spark, src, sink, ck, dl)
    assert r1.success and r1.rows_inserted == 10
    # H-19: the same 10 again -> still 10
    write_json_lines(ten, src)
    # H-20: the same 10 resent 30 minutes later (past the 1-minute window) -> still 10
    write_json_lines(ten.withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + F.expr("INTERVAL 30 MINUTES")), src)
    # H-22: malformed line and a line without required fields -> dead letters
    # (two equal bad lines are two bad lines)
    spark.createDataFrame([("{oops",), ("{oops",), ('{"event_id": "only-id"}',)], "value string").write.mode("append").text(src)
    r2 = ingest(spark, src, sink, ck, dl)
    assert r2.success and r2.rows_inserted == 0 and r2.dead_letters == 3
    stored = spark.read.parquet(sink)
    assert stored.count() == 10
    assert stored.groupBy("event_id").count().where("count > 1").count() == 0
    assert verify_deduplication(spark, sink, ten.first().event_id)
    reasons = sorted(r.reason for r in spark.read.parquet(dl).collect())
    assert reasons == ["malformed_json", "malformed_json", "missing_required_field"]


def test_late_events_with_new_ids_are_kept(spark, scratch):
    # H-21: 10 new ids whose event time is a day old are all kept.
    ten = _ten(spark)
    late = ten.withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + F.expr("INTERVAL 1 DAY"))
    src, sink, ck = (os.path.join(scratch, x) for x in ("src", "sink", "ck"))
    write_json_lines(late, src)
    r = ingest(spark, src, sink, ck)
    assert r.rows_inserted == 10


def test_first_arrivals_and_normalize(spark):
    rows = stream_rows_from_raw(raw_events(spark, "/root/testdata/sf0.001"))
    arr = with_resends(rows)
    assert arr.count() > rows.count()
    assert first_arrivals(arr).count() == rows.count()
    norm = normalize_stream_events(first_arrivals(arr))
    raw = raw_events(spark, "/root/testdata/sf0.001")
    assert norm.schema == raw.schema or [f.name for f in norm.schema] == [f.name for f in raw.schema]
    key = ["event_timestamp", "user_pseudo_id", "event_name", "event_date"]
    assert norm.select(key).exceptAll(raw.select(key)).count() == 0


def test_stream_gap_sessions_match_batch(spark, scratch):
    from touchline.operators.sessionize import gap_sessions, sessionize_by_gap
    from touchline.plans.models import Models
    from touchline.config import AttributionConfig
    from touchline.streaming.sessions import stream_gap_sessions
    from touchline.sources.schemas import RAW_EVENT_SCHEMA
    from touchline.operators.staging import stage_events
    cfg = AttributionConfig(as_of="2030-01-01 00:00:00")
    raw = raw_events(spark, "/root/testdata/sf0.001")
    src = os.path.join(scratch, "raw")
    raw.write.parquet(src)
    stream = stage_events(spark.readStream.schema(RAW_EVENT_SCHEMA).parquet(src), cfg)
    q = (stream_gap_sessions(stream).writeStream.format("memory").queryName("tl_stream_sessions")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT user_pseudo_id, session_day, session_start, session_end, events FROM tl_stream_sessions")
    want = gap_sessions(sessionize_by_gap(Models(raw, cfg).events)).drop("gap_session_id")
    # append mode emits sessions once the watermark passes them; everything
    # emitted must be a batch session
    assert got.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_the_batch_reads_only_its_dates_of_the_sink_and_damage_is_an_error(spark, scratch):
    import pytest

    from touchline.streaming.ingest import append_new_events
    rows = first_arrivals(stream_rows_from_raw(raw_events(spark, "/root/testdata/sf0.001"))).persist()
    sink = os.path.join(scratch, "sink")
    assert append_new_events(rows, sink) == rows.count()
    day = rows.agg(F.max("event_date")).first()[0]
    # Another event with the id of a stored one is not a repeat of it.
    one = rows.where(F.col("event_date") == F.lit(day)).limit(1)
    other = one.withColumn("user_pseudo_id", F.lit("someone else"))
    assert append_new_events(one.unionByName(other), sink) == 1
    # A date that the batch does not have may be unreadable; one that it has may not.
    broken = next(d for d in sorted(os.listdir(sink)) if d.startswith("event_date=") and d != f"event_date={day}")
    for f in os.listdir(os.path.join(sink, broken)):
        if f.startswith("part-"):
            with open(os.path.join(sink, broken, f), "wb") as out:
                out.write(b"damaged")
    for f in [x for x in os.listdir(os.path.join(sink, broken)) if x.startswith(".part-")]:
        os.remove(os.path.join(sink, broken, f))
    assert append_new_events(one, sink) == 0
    with pytest.raises(Exception):
        append_new_events(rows.where(F.col("event_date") == F.lit(broken.split("=")[1]).cast("date")), sink)


def test_failures_are_retried_and_batches_count_once(spark, scratch, monkeypatch):
    from touchline.streaming import ingest as module

    feed = module.stream_rows_from_raw(raw_events(spark, "/root/testdata/sf0.001"))
    src = module.write_json_lines(feed, f"{scratch}/in")
    n, failed, write = feed.count(), [], module.write_clustered

    def written_then_lost(*args, **kw):
        write(*args, **kw)
        if len(failed) < 2:
            failed.append(1)
            raise OSError("lost the answer")

    monkeypatch.setattr(module, "write_clustered", written_then_lost)
    report = module.ingest(spark, src, f"{scratch}/sink", f"{scratch}/ckpt")
    assert len(failed) == 1 and report.rows_inserted == n  # the second try found everything stored
    stored = module.read_event_table(spark, f"{scratch}/sink", module.STREAM_EVENT_SCHEMA)
    assert stored.count() == n == stored.select("event_id").distinct().count()
    log = module.CommitLog(spark, f"{scratch}/ckpt-batches")
    assert log.rows_done(0) == n and log.rows_done(1) in (None, 0) and log.rows_done(99) is None
    assert log.begun(0, 5) == n


def test_deadline():
    from touchline.streaming.ingest import with_deadline

    tries = []

    def fails(times):
        tries.append(1)
        if len(tries) <= times:
            raise OSError(len(tries))
        return "done"

    assert with_deadline(lambda: fails(3), 5, 0.01) == "done" and len(tries) == 4
    tries.clear()
    with pytest.raises(OSError):
        with_deadline(lambda: fails(99), 0.2, 0.05)
    assert 2 <= len(tries) <= 4


def test_no_frame_stays_cached(spark, scratch):
    from touchline.streaming.ingest import append_new_events, stream_rows_from_raw

    feed = stream_rows_from_raw(raw_events(spark, "/root/testdata/sf0.001"))
    held = lambda: spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    before = held()
    for part in range(3):
        append_new_events(feed.where(f"event_timestamp % 3 = {part}"), f"{scratch}/sink")
    assert held() == before


def test_resends_are_the_feed_without_its_first_arrivals(spark):
    from touchline.sources.scan import raw_events
    from touchline.streaming.ingest import resends, stream_rows_from_raw, with_resends
    feed = stream_rows_from_raw(raw_events(spark, "/root/testdata/sf0.001")).unionByName(
        stream_rows_from_raw(raw_events(spark, "/root/testdata/sf0.001")).where("event_timestamp % 5 = 0"))
    expected = with_resends(feed).exceptAll(feed)
    assert resends(feed).count() > 0
    assert resends(feed).exceptAll(expected).count() == 0 and expected.exceptAll(resends(feed)).count() == 0


def test_valid_lines_go_on_without_their_text(spark, scratch):
    from touchline.streaming.ingest import parse_lines
    src = os.path.join(scratch, "src")
    write_json_lines(_ten(spark), src)
    spark.createDataFrame([("{oops",), ('{"event_id": "only-id"}',)], "value string").write.mode("append").text(src)
    lines = parse_lines(spark.read.text(src))
    assert lines.where("_valid AND _line IS NULL").count() == 10
    assert sorted(r[0] for r in lines.where("NOT _valid").select("_line").collect()) == ['{"event_id": "only-id"}', "{oops"]


def _state_files(checkpoint):
    return {os.path.splitext(f)[1] for at, _, files in os.walk(f"{checkpoint}/state/0") if not at.endswith("_metadata")
            for f in files if f[0] not in "._"}


def test_keys_of_the_dedup_and_batches_are_not_kept_on_the_heap(spark, scratch):
    from touchline.streaming.ingest import STREAM_SETTINGS
    src = write_json_lines(_ten(spark), os.path.join(scratch, "src"))
    spark.createDataFrame([("{oops",), ("{oops",)], "value string").write.mode("append").text(src)
    cached = lambda: dict(spark.sparkContext._jsc.getPersistentRDDs())
    others, in_memory, blocks = {*cached()}, [], set()

    def kept(_, rows):
        blocks.add(rows.sparkSession.conf.get("spark.sql.inMemoryColumnarStorage.batchSize"))
        in_memory.extend(rdd.getStorageLevel().useMemory() for k, rdd in cached().items() if k not in others)

    for dead in (2, 0):
        r = ingest(spark, src, f"{scratch}/sink", f"{scratch}/ck", f"{scratch}/dl", kept)
        assert r.rows_inserted == (10 if dead else 0) and r.dead_letters == dead
        write_json_lines(_ten(spark), src)
    # Files of the store on disk; the one on the heap leaves .delta files.
    assert ".zip" in _state_files(f"{scratch}/ck") and ".delta" not in _state_files(f"{scratch}/ck")
    # A batch is on disk between its steps, in small blocks.
    assert in_memory and not any(in_memory) and blocks == {"250"}
    assert all(spark.conf.get(key, None) is None for key in STREAM_SETTINGS)


def test_the_state_store_of_the_session_and_of_an_older_checkpoint_stays(spark, scratch):
    from touchline.streaming.ingest import STATE_STORE
    src = write_json_lines(_ten(spark), os.path.join(scratch, "src"))
    key = f"{STATE_STORE}.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        assert ingest(spark, src, f"{scratch}/sink", f"{scratch}/ck").rows_inserted == 10
    finally:
        spark.conf.unset(key)
    write_json_lines(_ten(spark), src)
    assert ingest(spark, src, f"{scratch}/sink", f"{scratch}/ck").rows_inserted == 0
    assert ".delta" in _state_files(f"{scratch}/ck") and ".zip" not in _state_files(f"{scratch}/ck")
