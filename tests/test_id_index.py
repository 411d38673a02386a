import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from touchline.sources.scan import raw_events
from touchline.sources.schemas import STREAM_EVENT_SCHEMA
from touchline.sources.sinks import read_event_table
from touchline.streaming import ingest as module
from touchline.streaming.ingest import append_new_events, first_arrivals, stream_rows_from_raw


@pytest.fixture
def rows(spark):
    return first_arrivals(stream_rows_from_raw(raw_events(spark, "/root/testdata/sf0.001"))).persist()


def data_files(path):
    return [os.path.join(at, f) for at, _, files in os.walk(path) for f in files if f.startswith("part-")]


def damage(path):
    for f in data_files(path):
        with open(f, "wb") as out:
            out.write(b"damaged")
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def others(rows):
    """Events of the same dates that aren't stored."""
    return rows.withColumn("user_pseudo_id", F.concat("user_pseudo_id", F.lit("-x")))


def test_new_events_open_no_file_of_the_sink(spark, scratch, rows):
    sink, ids, n = os.path.join(scratch, "sink"), os.path.join(scratch, "ids"), rows.count()
    assert append_new_events(rows, sink, ids=ids) == n
    assert append_new_events(rows.unionByName(others(rows).limit(5)), sink, ids=ids) == 5
    assert read_event_table(spark, sink, STREAM_EVENT_SCHEMA).count() == n + 5
    damage(sink)
    fresh = others(others(rows))
    assert append_new_events(fresh, sink, ids=ids) == n  # all of the sink's dates, none of its files
    with pytest.raises(Exception):
        append_new_events(rows.limit(1), sink, ids=ids)  # a stored one: its date is read
    with pytest.raises(Exception):
        append_new_events(others(fresh), sink)  # without the index all dates of the batch are read


def test_only_dates_with_a_known_event_are_read(spark, scratch, rows):
    sink, ids = os.path.join(scratch, "sink"), os.path.join(scratch, "ids")
    append_new_events(rows, sink, ids=ids)
    days = sorted(r["event_date"] for r in rows.select("event_date").distinct().collect())
    damage(os.path.join(sink, f"event_date={days[0]}"))
    again = rows.where(F.col("event_date") == F.lit(days[1]))
    new = others(rows.where(F.col("event_date") == F.lit(days[0])))
    assert append_new_events(again.unionByName(new), sink, ids=ids) == new.count()


def test_an_absent_index_is_built_and_an_empty_batch_is_nothing(spark, scratch, rows):
    sink, ids = os.path.join(scratch, "sink"), os.path.join(scratch, "ids")
    n = append_new_events(rows, sink)
    assert append_new_events(rows, sink, ids=ids) == 0
    assert spark.read.parquet(ids).count() == n
    assert append_new_events(rows.limit(0), sink, ids=ids) == 0
    far = rows.withColumn("event_date", F.col("event_date") + timedelta(days=4000))
    assert append_new_events(far, sink, ids=ids) == n  # dates that neither has


@pytest.mark.parametrize("lost_after", [1, 2])
def test_a_batch_that_failed_between_index_and_sink_is_stored_once(spark, scratch, rows, monkeypatch, lost_after):
    sink, ids, n = os.path.join(scratch, "sink"), os.path.join(scratch, "ids"), rows.count()
    calls, write = [], module.write_clustered

    def lost(df, path, *args, **kw):
        if path == sink:
            calls.append(path)
            if lost_after == 2:
                write(df, path, *args, **kw)
            if len(calls) == 1:
                raise OSError("lost")
            if lost_after == 2:
                return
        write(df, path, *args, **kw)

    monkeypatch.setattr(module, "write_clustered", lost)
    with pytest.raises(OSError):
        append_new_events(rows, sink, ids=ids)
    append_new_events(rows, sink, ids=ids)
    stored = read_event_table(spark, sink, STREAM_EVENT_SCHEMA)
    assert stored.count() == n == stored.select("event_id", "user_pseudo_id", "event_name", "event_timestamp").distinct().count()
