"""Ordered conversion funnel: view, cart, checkout, purchase, each after the last and within a time limit of the first.

A user reaches step k at an event of that step if earlier events of steps 1 to k-1, one after another, lead to
it and the first is at most the limit ago.  Of several such first events the latest counts (it is the
start that leaves most time), so two numbers are told of each step: when it was first reached, and when
that passage began.

No task holds a user.  Each (user, time bucket) is summed up on its own, by running maxima:

* ``start_k``: the latest start of a passage to step k inside the bucket, and the first time step k is
  reached that way;
* ``end_j_k``: the earliest end of steps j+1 to k inside the bucket, for a passage that reached step j before.

The summaries of a user's buckets are composed in order: a passage at step j whose start is within the
limit of ``end_j_k`` goes on to step k.  A user has at most one short summary a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS = ("page_view", "add_to_cart", "begin_checkout", "purchase")
LIMIT_HOURS = 72
MICROS = 3_600_000_000
_START = "struct<ts:bigint,channel:string>"
_REACHED = "struct<ts:bigint,ago:bigint,channel:string>"


def _least(*columns: Column) -> Column:
    return F.least(*columns) if len(columns) > 1 else columns[0]


def _greatest(*columns: Column) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def bucket_summaries(events: DataFrame, steps: tuple[str, ...] = STEPS, limit_hours: float = LIMIT_HOURS, bucket_hours: int = 24) -> DataFrame:
    """user, bucket, and for every step k: start_k, first_k, end_j_k of 0 < j < k (step numbers count from 1)."""
    n, limit = len(steps), int(limit_hours * MICROS)
    step = F.lit(None).cast("int")
    for k, name in enumerate(steps, 1):
        step = F.when(F.col("event_name") == name, k).otherwise(step)
    # Events of one user, step and instant are one, with the largest channel.
    rows = (events.where(F.col("event_name").isin(*steps) & F.col("user_pseudo_id").isNotNull())
            .select(F.col("user_pseudo_id").alias("user"), F.col("event_timestamp").alias("ts"), step.alias("step"), "channel")
            .groupBy("user", "ts", "step").agg(F.max("channel").alias("channel"))
            .withColumn("bucket", F.floor(F.col("ts") / (bucket_hours * MICROS))))
    before = Window.partitionBy("user", "bucket").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("s1", F.when(F.col("step") == 1, F.struct("ts", "channel").cast(_START)))
    rows = rows.withColumns({f"e{j}_{j + 1}": F.col("step") == j + 1 for j in range(1, n)})
    for k in range(2, n + 1):
        last = F.max(f"s{k - 1}").over(before)
        new = {f"_s{k}": last}
        for j in range(1, k - 1):
            new[f"e{j}_{k}"] = (F.col("step") == k) & F.coalesce(F.max(f"e{j}_{k - 1}").over(before), F.lit(False))
        rows = rows.withColumns(new)
        good = (F.col("step") == k) & (F.col("ts") - F.col(f"_s{k}.ts") <= limit)
        rows = rows.withColumn(f"s{k}", F.when(good, F.col(f"_s{k}"))).drop(f"_s{k}")
    out = []
    for k in range(1, n + 1):
        s = F.col(f"s{k}")
        first = F.when(s.isNotNull(), F.struct(F.col("ts"), (-s["ts"]).alias("ago"), s["channel"].alias("channel")).cast(_REACHED))
        out += [F.max(s).alias(f"start_{k}"), F.min(first).alias(f"first_{k}")]
        out += [F.min(F.when(F.col(f"e{j}_{k}"), F.col("ts"))).alias(f"end_{j}_{k}") for j in range(1, k)]
    return rows.groupBy("user", "bucket").agg(*out)


def funnel_progress(events: DataFrame, steps: tuple[str, ...] = STEPS, limit_hours: float = LIMIT_HOURS, bucket_hours: int = 24) -> DataFrame:
    """user_pseudo_id, step (from 1), reached_at, started_at (microseconds), channel (of the starting event): one row
    for each step a user reaches.  Events of other names, without a user or at the same instant as the step before
    lead nowhere."""
    n, limit = len(steps), int(limit_hours * MICROS)
    summaries = bucket_summaries(events, steps, limit_hours, bucket_hours)
    fields = [c for c in summaries.columns if c not in ("user", "bucket")]
    users = summaries.groupBy("user").agg(F.sort_array(F.collect_list(F.struct("bucket", *fields))).alias("_all"))
    names = [f"{kind}{k}" for k in range(1, n + 1) for kind in "sr"]
    zero = F.struct(*[F.lit(None).cast(_START if x[0] == "s" else _REACHED).alias(x) for x in names])

    def then(state: Column, b: Column) -> Column:
        out = []
        for k in range(1, n + 1):
            starts, reached = [b[f"start_{k}"], state[f"s{k}"]], [b[f"first_{k}"]]
            for j in range(1, k):
                s, end = state[f"s{j}"], b[f"end_{j}_{k}"]
                good = end - s["ts"] <= limit
                starts.append(F.when(good, s))
                reached.append(F.when(good, F.struct(end.alias("ts"), (-s["ts"]).alias("ago"), s["channel"].alias("channel"))))
            out += [_greatest(*starts).cast(_START).alias(f"s{k}"), F.coalesce(state[f"r{k}"], _least(*reached)).cast(_REACHED).alias(f"r{k}")]
        return F.struct(*out)

    done = users.select(F.col("user").alias("user_pseudo_id"), F.aggregate("_all", zero, then).alias("_end"))
    each = F.array(*[F.struct(F.lit(k).alias("step"), F.col(f"_end.r{k}").alias("r")) for k in range(1, n + 1)])
    return (done.select("user_pseudo_id", F.explode(each).alias("_s")).where("_s.r IS NOT NULL")
            .select("user_pseudo_id", "_s.step", F.col("_s.r.ts").alias("reached_at"), (-F.col("_s.r.ago")).alias("started_at"), F.col("_s.r.channel").alias("channel")))


def funnel_by_channel(progress: DataFrame, steps: tuple[str, ...] = STEPS) -> DataFrame:
    """channel, step, step_name, users, median_seconds (from the start to the step).

    Whole seconds within the limit are counted, so the median's table of counts is bounded by the limit."""
    seconds = F.floor((F.col("reached_at") - F.col("started_at")) / 1_000_000)
    return (progress.groupBy("channel", "step").agg(F.count(F.lit(1)).alias("users"), F.median(seconds).alias("median_seconds"))
            .withColumn("step_name", F.get(F.array(*map(F.lit, steps)), F.col("step") - 1)))
