"""Idempotent streaming ingestion of raw events.

Source: JSON lines in a directory (file source, no ports).  Each line is
parsed with the explicit streamed-event schema; malformed lines and rows
missing a required field go to a dead-letter sink.

Deduplication runs on two horizons:

* short: ``dropDuplicatesWithinWatermark`` over the payload key (id and
  producer stamp), with a 1-minute watermark on *processing* time (when
  the row reached this job), so no row is ever behind the watermark and
  late or re-stamped events are never dropped as late data.  The keys are
  as many as the lines of a run; they lie on local disks, not in memory;
* long: inside ``foreachBatch`` the batch is de-duplicated and anti-joined
  against the sink on ``event_id``, reading only the ``event_date``
  partitions the batch touches (the id embeds the timestamp, so a
  duplicate always lands in the same date partition).

The sink is Parquet partitioned by ``event_date``; the checkpoint makes
restarts exactly-once in effect, and re-running a batch is harmless
because of the anti-join.
"""

from __future__ import annotations

import hashlib
import os
import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.ids import hashed_event_id
from touchline.session import unset_filled_in
from touchline.sources.schemas import RAW_EVENT_SCHEMA, STREAM_EVENT_SCHEMA
from touchline.sources.sinks import read_event_table, table_exists, write_clustered
from touchline.streaming.id_index import StoredIds

CORRUPT = "_corrupt_record"
REQUIRED = [f.name for f in STREAM_EVENT_SCHEMA.fields if not f.nullable]
# Fixed value: short-horizon dedup window on arrival time.
DEDUP_WINDOW = "1 minute"
# How long a failing batch is tried again.
RETRY_SECONDS = 30
# Wire format of timestamps: ISO-8601 with microseconds and offset.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# The default store keeps every key of the dedup on the executors' heaps.  This one keeps them on local disks, and all
# its instances in an executor share one block of memory outside the heap.  Counting its keys would read each once more.
STATE_STORE = "spark.sql.streaming.stateStore"
STREAM_SETTINGS = {
    f"{STATE_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE_STORE}.rocksdb.maxMemoryUsageMB": "256",
    f"{STATE_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    # Rows of a block of the batch's cache: a task that reads a partition from disk holds 100 blocks, as the serializer
    # forgets them only then, and no one counts them.
    "spark.sql.inMemoryColumnarStorage.batchSize": "250",
}
# Where a batch is kept between its steps: in memory it took the room of the sorts that read it.
CACHE = StorageLevel.DISK_ONLY


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


PARSE_SCHEMA = T.StructType(_nullable(STREAM_EVENT_SCHEMA).fields + [T.StructField(CORRUPT, T.StringType(), True)])


def stream_rows_from_raw(raw: DataFrame, lag_seconds: int = 5) -> DataFrame:
    """Streamed-event rows derived from raw batch events: hashed id, DATE
    partition, flat browser, and an arrival stamp ``1..lag_seconds`` seconds
    after the event time (deterministic)."""
    event_time = F.timestamp_micros("event_timestamp")
    lag = (F.col("event_timestamp") % lag_seconds + 1).cast("int")
    return raw.where(F.col("event_timestamp").isNotNull() & F.col("user_pseudo_id").isNotNull()
                     & F.col("event_name").isNotNull()).select(
        hashed_event_id("user_pseudo_id", "event_name", "event_timestamp").alias("event_id"),
        F.to_date(event_time).alias("event_date"),
        "event_timestamp", "event_name", "user_pseudo_id", "user_id", "event_params", "traffic_source",
        F.struct(F.col("device.category").alias("category"),
                 F.col("device.operating_system").alias("operating_system"),
                 F.col("device.web_info.browser").alias("browser")).alias("device"),
        "geo", "ecommerce", "stream_id", "platform",
        (event_time + F.make_dt_interval(secs=lag)).alias("ingestion_timestamp"),
    )


def resends(rows: DataFrame, every: int = 10, delay_minutes: int = 30) -> DataFrame:
    """Rows whose timestamp is divisible by ``every`` once more, arriving ``delay_minutes`` later."""
    return rows.where(F.col("event_timestamp") % every == 0).withColumn(
        "ingestion_timestamp", F.col("ingestion_timestamp") + F.make_dt_interval(mins=F.lit(delay_minutes)))


def with_resends(rows: DataFrame, every: int = 10, delay_minutes: int = 30) -> DataFrame:
    """Arrival feed: every row once, plus a resend of rows whose timestamp is
    divisible by ``every``, arriving ``delay_minutes`` later (a client retry
    outside the short dedup window)."""
    return rows.unionByName(resends(rows, every, delay_minutes))


def first_arrivals(arrivals: DataFrame) -> DataFrame:
    """Batch form of the two-horizon dedup: the earliest arrival per event.
    ``min_by`` is a partial aggregate, so a hot id is combined map-side."""
    cols = [c for c in arrivals.columns if c not in (*SAME_EVENT, "ingestion_timestamp")]
    agg = arrivals.groupBy(*SAME_EVENT).agg(
        F.min("ingestion_timestamp").alias("ingestion_timestamp"),
        F.min_by(F.struct(*cols), "ingestion_timestamp").alias("_row"),
    )
    return agg.select(*SAME_EVENT, *[F.col(f"_row.{c}").alias(c) for c in cols], "ingestion_timestamp") \
        .select(*arrivals.columns)


def normalize_stream_events(stream: DataFrame) -> DataFrame:
    """Streamed rows -> the raw batch layout (yyyyMMdd ``event_date``,
    ``device.web_info.browser``), so both feeds can be unioned before staging."""
    return stream.select(
        F.date_format("event_date", "yyyyMMdd").alias("event_date"),
        "event_timestamp", "event_name", "user_pseudo_id", "user_id", "event_params", "traffic_source",
        F.struct(F.col("device.category").alias("category"),
                 F.col("device.operating_system").alias("operating_system"),
                 F.struct(F.col("device.browser").alias("browser")).alias("web_info")).alias("device"),
        "geo", "ecommerce", "platform", "stream_id",
    ).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_EVENT_SCHEMA.fields])


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text -> typed columns plus ``_corrupt_record``, ``_valid`` and, of invalid lines only, ``_line``.

    A line is invalid when it does not parse or a REQUIRED field is NULL."""
    parsed = lines.select(
        F.from_json(F.col(column), PARSE_SCHEMA,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
                     "timestampFormat": TIMESTAMP_FORMAT}).alias("r"),
        F.col(column).alias("_line"),
    ).select("r.*", "_line")
    valid = F.col(CORRUPT).isNull()
    for c in REQUIRED:
        valid = valid & F.col(c).isNotNull()
    # The text of a valid line is not needed again: it would go through the shuffle and the cache beside its columns.
    return parsed.withColumn("_valid", valid).withColumn("_line", F.when(~F.col("_valid"), F.col("_line")))


def split_dead_letters(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = parsed.where(F.col("_valid")).select(*[f.name for f in STREAM_EVENT_SCHEMA.fields])
    bad = parsed.where(~F.col("_valid")).select(
        F.col("_line").alias("raw_line"),
        F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed_json"))
        .otherwise(F.lit("missing_required_field")).alias("reason"),
    )
    return good, bad


def dedup_short_horizon(stream: DataFrame, window: str = DEDUP_WINDOW) -> DataFrame:
    """Drop repeats of the same payload (id + producer stamp) reaching the
    job within ``window`` of processing time of each other."""
    return (stream.withColumn("_arrival", F.current_timestamp())
            .withWatermark("_arrival", window)
            .dropDuplicatesWithinWatermark(["event_id", "ingestion_timestamp"])
            .drop("_arrival"))


# The id alone is a 64-bit prefix; rows are the same event only if these agree too.
SAME_EVENT = ("event_id", "user_pseudo_id", "event_name", "event_timestamp")


class CommitLog:
    """What became of each batch of a stream: begun (with the rows it set out to write), then done.

    A batch that is done is not run again; one that was begun and failed is completed: what it has
    stored already is found by the anti-join with the sink.  One small file a state and batch.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, batch_id: int, state: str) -> str:
        return f"{self.path}/batch={batch_id}/{state}"

    def _rows(self, batch_id: int, state: str) -> int | None:
        path = self._at(batch_id, state)
        if not table_exists(self.spark, f"{path}/_SUCCESS"):
            return None
        return self.spark.read.schema("rows long").json(path).first()["rows"]

    def _write(self, batch_id: int, state: str, rows: int) -> None:
        self.spark.range(1).select(F.lit(rows).cast("long").alias("rows")).coalesce(1).write.mode("overwrite").json(self._at(batch_id, state))

    def begun(self, batch_id: int, rows: int) -> int:
        """Notes the rows a batch is about to write; returns what it noted at its first try."""
        first = self._rows(batch_id, "begun")
        if first is None:
            self._write(batch_id, "begun", rows)
        return rows if first is None else first

    def done(self, batch_id: int, rows: int) -> None:
        self._write(batch_id, "done", rows)

    def rows_done(self, batch_id: int) -> int | None:
        """Rows of a batch that is done, else None."""
        return self._rows(batch_id, "done")


def with_deadline(action, seconds: float = RETRY_SECONDS, first_wait: float = 0.5, transient: tuple = (Exception,)):
    """Runs action until it succeeds; failures are repeated with doubled waits until ``seconds`` have passed,
    then the last one is raised."""
    end, wait = time.monotonic() + seconds, first_wait
    while True:
        try:
            return action()
        except transient:
            if time.monotonic() + wait > end:
                raise
            time.sleep(wait)
            wait *= 2


def append_new_events(batch: DataFrame, sink: str, batch_id: int | None = None, log: CommitLog | None = None,
                      ids: str | None = None) -> int:
    """Long-horizon dedup + append (the ``foreachBatch`` body).

    Keeps the earliest arrival per event within the batch, removes events
    already in the sink, appends the rest partitioned by ``event_date``.
    Of the sink only the batch's dates are read: there are as many of them
    as days, so they go into the partition filter as values.  With ``ids``, the
    folder of an index of the sink's events, only those of them on which the
    index has an event of the batch.  Returns the rows written."""
    spark = batch.sparkSession
    index = StoredIds(spark, ids, SAME_EVENT) if ids is not None else None
    arrived = first_arrivals(batch).persist(CACHE)
    try:
        fresh = arrived
        dates = [r["event_date"] for r in arrived.select("event_date").distinct().collect()]
        if table_exists(spark, sink) and dates:
            stored = read_event_table(spark, sink, STREAM_EVENT_SCHEMA)
            if index is not None:
                index.cover(stored)
                dates = index.dates_to_look_at(arrived, dates)
        else:
            dates = []
        if dates:
            stored = (stored.where(F.col("event_date").isin(dates)).select(*[F.col(c).alias(f"_{c}") for c in SAME_EVENT], "event_date"))
            same = fresh["event_date"] == stored["event_date"]
            for c in SAME_EVENT:
                same = same & fresh[c].eqNullSafe(stored[f"_{c}"])
            fresh = fresh.join(stored, same, "left_anti")
        new = fresh.persist(CACHE) if fresh is not arrived else arrived
        try:
            n = left = new.count()
            if log is not None and batch_id is not None:
                # Of a batch that is tried again, what it first set out to write counts.
                n = log.begun(batch_id, left)
            if left:
                if index is not None:
                    index.add(new)
                write_clustered(new, sink, "event_date", ("event_name", "user_pseudo_id"))
        finally:
            if new is not arrived:
                new.unpersist()
        return n
    finally:
        arrived.unpersist()


@dataclass
class IngestReport:
    """Outcome of one ingest run (rows, latency, errors)."""

    success: bool
    rows_inserted: int
    dead_letters: int
    latency_seconds: float
    batches: int
    errors: list = field(default_factory=list)


def ingest(spark: SparkSession, source_dir: str, sink: str, checkpoint: str,
           dead_letter: str | None = None, refresh=None,
           dedup_window: str = DEDUP_WINDOW, retry_seconds: float = RETRY_SECONDS,
           ids: str | None = None) -> IngestReport:
    """Run the ingestion stream over everything currently in ``source_dir``
    (``availableNow``) and report what was written.

    Both dedup horizons apply: the watermark state drops repeats arriving
    within ``dedup_window``; the batch body anti-joins against the sink.
    ``refresh(spark, new_rows_df)`` is called per batch after the append
    (e.g. to rebuild the marts of the affected dates).  A batch that fails is
    tried again for ``retry_seconds``; a log beside the checkpoint makes a batch
    that was done already, or in part, count and write once.  ``ids`` names the
    folder of an index of the sink's events (see ``id_index``); without it the
    sink's rows of the batch's dates are read.  A state store that the session
    or an older checkpoint names stays in use."""
    counts = {"rows": 0, "dead": 0, "batches": 0}
    log = CommitLog(spark, f"{checkpoint.rstrip('/')}-batches")
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def on_batch(df: DataFrame, batch_id: int):
        done = log.rows_done(batch_id)
        if done is None:
            with_deadline(lambda: run_batch(df, batch_id), retry_seconds)
        else:
            counts["rows"] += done
            counts["batches"] += 1

    def run_batch(df: DataFrame, batch_id: int):
        df = df.persist(CACHE)
        try:
            good, bad = split_dead_letters(df)
            nbad = 0
            if dead_letter is not None:
                nbad = bad.count()
                if nbad:
                    # A folder of the batch's own: a second try writes it over.
                    bad.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
                        f"{dead_letter}/stream={stream}/batch={batch_id}")
            rows = append_new_events(good, sink, batch_id, log, ids)
            if refresh is not None:
                refresh(spark, good)
            log.done(batch_id, rows)
            counts["rows"] += rows
            counts["dead"] += nbad
            counts["batches"] += 1
        finally:
            df.unpersist()

    parsed = parse_lines(spark.readStream.format("text").load(source_dir))
    # Short horizon: the state drops repeats of the same payload (same id and
    # producer stamp) seen within ``dedup_window`` of *processing* time.  The
    # watermark must not use the producer's stamp: rows stamped earlier than
    # ones already seen (clock skew, retries) would fall behind it and be
    # dropped as late.  Repeats with a different stamp are resolved in the
    # batch body (earliest stamp in the batch, then the sink anti-join).
    # A bad line is never a repeat: each has a key of its own and is counted.
    keyed = parsed.withColumns({
        "_key": F.when(F.col("_valid"), F.concat_ws("|", F.col("event_id"),
                                                     F.col("ingestion_timestamp").cast("string")))
                 .otherwise(F.concat(F.lit("bad:"), F.uuid())),
        "_arrival": F.current_timestamp(),
    })
    deduped = keyed.withWatermark("_arrival", dedup_window).dropDuplicatesWithinWatermark(["_key"])
    t0 = time.perf_counter()
    with unset_filled_in(spark, STREAM_SETTINGS):  # the stream takes its settings when it starts
        query = (deduped.writeStream.foreachBatch(on_batch)
                 .option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
    query.awaitTermination()  # a failed batch raises here
    latency = time.perf_counter() - t0
    return IngestReport(True, counts["rows"], counts["dead"], latency, counts["batches"])


def verify_deduplication(spark: SparkSession, sink: str, event_id: str) -> bool:
    """True when ``event_id`` is stored exactly once (point lookup)."""
    return spark.read.parquet(sink).where(F.col("event_id") == event_id).count() == 1


def write_json_lines(rows: DataFrame, directory: str) -> str:
    """Write rows as JSON lines (a file-source fixture or a replay)."""
    rows.write.mode("append").option("timestampFormat", TIMESTAMP_FORMAT).json(directory)
    return directory


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's checkpoint directory (shared
    storage on a cluster)."""
    from touchline.session import checkpoint_dir
    base = checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{time.time_ns()}")
    return path
