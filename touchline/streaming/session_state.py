"""Streamed sessions that correct themselves, however late an event comes.

A session of a user-day is an interval and a number of events, and intervals that are at most
``timeout`` apart merge exactly, in any order.  So:

* each Arrow batch of events is reduced to its intervals before the shuffle; a hot user sends a
  few rows a batch, not its events;
* a (user, UTC day) has a list of intervals, at most as many as timeouts fit into a
  day.  Events that come late extend, join or bridge intervals; what changed goes out at once:
  sessions that are new or different as ``open``, those that another one took in as ``withdrawn``;
* users are dealt to ``BUCKETS`` by hash, and the state of a (bucket, UTC day) holds those of its
  users: reading and writing state takes a few calls a bucket, not a few for every user;
* a user-day that has been quiet for ``keep_minutes`` is closed by a processing-time timer, which stands
  at the bucket's earliest such time: its sessions go out once more as ``closed`` and leave the state.
  An event that comes still later starts another epoch of the user-day, and ``current_sessions`` merges the epochs.

There is no event-time watermark, so no event is dropped as late.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from touchline.functions.ids import dash_id

TIMEOUT_MINUTES = 30
KEEP_MINUTES = 2 * 24 * 60
# Parts of the users whose state of a day is kept together.
BUCKETS = 256
MINUTE = 60 * 1_000_000
# State variables and timers need this store; without batches that have no data a run over what there is
# would not end, since processing-time timers ask for another batch each time.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
INTERVALS = "user_pseudo_id string, day int, first long, last long, events long"
CHANGES = "user_pseudo_id string, day int, epoch long, revision long, first long, last long, events long, state string"
# A row for each session of the bucket's users; epoch, revision and due (when it closes) are its user-day's.
KEPT = pa.schema([("user", pa.string()), *((x, pa.int64()) for x in ("first", "last", "events", "epoch", "revision", "due"))])
STATE = "sessions binary"


def intervals(events: DataFrame, timeout_minutes: int = TIMEOUT_MINUTES) -> DataFrame:
    """user_pseudo_id, day (days since 1970), first, last (microseconds), events: one row per run of a
    user-day's events within an Arrow batch.  Events without a user or a time are in no session."""
    gap = timeout_minutes * MINUTE

    def reduce(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame.sort_values(["user_pseudo_id", "day", "at"])
            same = (frame["user_pseudo_id"] == frame["user_pseudo_id"].shift()) & (frame["day"] == frame["day"].shift())
            run = (~same | (frame["at"].diff() > gap)).cumsum()
            yield frame.groupby(run.rename("run")).agg(
                user_pseudo_id=("user_pseudo_id", "first"), day=("day", "first"),
                first=("at", "first"), last=("at", "last"), events=("at", "size"))

    rows = events.where(F.col("user_pseudo_id").isNotNull() & F.col("event_datetime").isNotNull()).select(
        "user_pseudo_id", F.unix_date(F.to_date("event_datetime")).alias("day"), F.unix_micros("event_datetime").alias("at"))
    return rows.mapInPandas(reduce, INTERVALS)


def put_in(sessions: list[tuple[int, int, int]], first: int, last: int, events: int, gap: int) -> None:
    """Adds an interval to sessions (sorted, more than gap apart), merging those within gap of it."""
    low = bisect_left(sessions, first - gap, key=lambda s: s[1])
    high = bisect_right(sessions, last + gap, key=lambda s: s[0])
    met = sessions[low:high]
    sessions[low:high] = [(min([first, *(s[0] for s in met)]), max([last, *(s[1] for s in met)]), events + sum(s[2] for s in met))]


class SessionKeeper(StatefulProcessor):
    """The sessions of one (bucket of users, UTC day)."""

    def __init__(self, timeout_minutes: int, keep_minutes: float):
        self.gap, self.keep_ms = timeout_minutes * MINUTE, int(keep_minutes * 60_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("sessions", STATE)

    def _load(self) -> dict[str, tuple[int, int, int, list]]:
        """user -> epoch, revision, due, sessions"""
        state, users = self.kept.get(), {}
        if state is not None:
            columns = pa.ipc.open_stream(state[0]).read_all().to_pydict().values()
            for user, first, last, events, epoch, revision, due in zip(*columns):
                users.setdefault(user, (epoch, revision, due, []))[3].append((first, last, events))
        return users

    def _store(self, users: dict[str, tuple[int, int, int, list]], timer: int | None) -> None:
        """Writes the state and moves the timer, which is at timer now, to the earliest due."""
        rows = [(user, *s, epoch, revision, due) for user, (epoch, revision, due, sessions) in users.items() for s in sessions]
        if rows:
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, KEPT) as stream:
                stream.write_table(pa.table([list(x) for x in zip(*rows)], schema=KEPT))
            self.kept.update((out.getvalue().to_pybytes(),))
        else:
            self.kept.clear()
        due = self._timer(users)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)

    @staticmethod
    def _timer(users: dict[str, tuple[int, int, int, list]]) -> int | None:
        return min((due for _, _, due, _ in users.values()), default=None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now, users, arrived = timerValues.getCurrentProcessingTimeInMs(), self._load(), {}
        timer = self._timer(users)
        for frame in rows:
            for user, *interval in zip(*(frame[x].tolist() for x in ("user_pseudo_id", "first", "last", "events"))):
                arrived.setdefault(user, []).append(interval)
        changes = []
        for user, found in arrived.items():
            epoch, revision, _, before = users.get(user, (now, 0, None, []))
            after = before.copy()
            for interval in found:
                put_in(after, *interval, self.gap)
            users[user] = (epoch, revision + 1, now + self.keep_ms, after)
            starts, known = {s[0] for s in after}, set(before)
            changes += [(user, epoch, revision + 1, *s, "withdrawn") for s in before if s[0] not in starts]
            changes += [(user, epoch, revision + 1, *s, "open") for s in after if s not in known]
        self._store(users, timer)
        yield self._changes(key, changes)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, timer, users = timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs(), self._load()
        quiet = [user for user, (_, _, due, _) in users.items() if due < now or due <= timer]
        changes = []
        for user in quiet:
            epoch, revision, _, sessions = users.pop(user)
            changes += [(user, epoch, revision + 1, *s, "closed") for s in sessions]
        self._store(users, timer)
        yield self._changes(key, changes)

    @staticmethod
    def _changes(key, changes: list[tuple]) -> pd.DataFrame:
        found = pd.DataFrame(changes, columns=["user_pseudo_id", "epoch", "revision", "first", "last", "events", "state"])
        found.insert(1, "day", int(key[1]))
        return found

    def close(self) -> None:
        pass


def session_changes(events: DataFrame, timeout_minutes: int = TIMEOUT_MINUTES, keep_minutes: float = KEEP_MINUTES) -> DataFrame:
    """The changes of sessions over a stream of staged events (append mode, RocksDB state store).

    user_pseudo_id, session_day, epoch, revision, session_start, session_end, events, state
    (``open``, ``withdrawn`` or ``closed``).
    """
    dealt = intervals(events, timeout_minutes).withColumn("bucket", F.pmod(F.xxhash64("user_pseudo_id"), F.lit(BUCKETS)))
    out = dealt.groupBy("bucket", "day").transformWithStateInPandas(
        SessionKeeper(timeout_minutes, keep_minutes), CHANGES, "Append", "ProcessingTime")
    return out.select("user_pseudo_id", F.date_from_unix_date("day").alias("session_day"), "epoch", "revision",
                      F.timestamp_micros("first").alias("session_start"), F.timestamp_micros("last").alias("session_end"),
                      "events", "state")


def store_session_changes(spark: SparkSession, events: DataFrame, sink: str, checkpoint: str,
                          timeout_minutes: int = TIMEOUT_MINUTES, keep_minutes: float = KEEP_MINUTES) -> None:
    """Runs the stream over all that its source has now and appends the changes to a Parquet sink.

    Timers that are due fire with the next run's events; open sessions are in the sink already.  The
    sink's log lists each batch's files once, so a batch that is run again is stored once.
    """
    before = {setting: spark.conf.get(setting, None) for setting in STREAM_SETTINGS}
    for setting, value in STREAM_SETTINGS.items():
        spark.conf.set(setting, value)  # the stream takes its settings when it starts
    try:
        query = (session_changes(events, timeout_minutes, keep_minutes).writeStream.format("parquet").option("path", sink)
                 .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    finally:
        for setting, value in before.items():
            if value is None:
                spark.conf.unset(setting)
            else:
                spark.conf.set(setting, value)
    query.awaitTermination()  # a failed batch raises here


def current_sessions(changes: DataFrame, timeout_minutes: int = TIMEOUT_MINUTES) -> DataFrame:
    """The sessions as the stored changes leave them, in the columns of ``gap_sessions``.

    The last revision of each session counts (a partial aggregate); sessions of different epochs of a
    user-day merge by the same rule.  A window holds a user-day's sessions, never its events.
    """
    key = ("user_pseudo_id", "session_day")
    last = changes.groupBy(*key, "epoch", "session_start").agg(
        F.max_by(F.struct("session_end", "events", "state"), "revision").alias("s"))
    kept = last.where(F.col("s.state") != "withdrawn").select(*key, "epoch", "session_start", "s.session_end", "s.events")
    in_day = Window.partitionBy(*key).orderBy("session_start", "epoch")
    reached = F.unix_micros(F.max("session_end").over(in_day.rowsBetween(Window.unboundedPreceding, -1)))
    opens = F.when(reached.isNull() | (F.unix_micros("session_start") - reached > timeout_minutes * MINUTE), 1).otherwise(0)
    numbered = kept.withColumn("_opens", opens).withColumn(
        "_nth", F.sum("_opens").over(in_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(*key, "_nth").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        F.sum("events").alias("events"),
    ).select(dash_id("user_pseudo_id", F.date_format("session_day", "yyyyMMdd"), F.col("_nth").cast("bigint")).alias("gap_session_id"),
             *key, "session_start", "session_end", "events")
