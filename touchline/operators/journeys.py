"""User journeys: each conversion paired with its earlier touchpoints.

The pairing is an equi-join on the user plus a time-range residual
(touch strictly before the conversion, inside the lookback).  Joining on
the user alone would put all of a heavy user's conversions and touches
into one task and test every pair.  Instead each conversion is replicated
into the day buckets its lookback covers and the join key is
``(user, day bucket)``: a touch matches exactly one bucket, candidates are
limited to the lookback, and a heavy user spreads over many keys (AQE
skew-join splits a still-hot bucket further).  No pair outside a
conversion's own window is ever produced.

The ranked plan knows each journey's run of ranks before it forms pairs, so
its key is ``(user, slice of ranks)`` and a conversion comes once for each
slice its journey touches.  Pairs are never shuffled there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.ids import dash_id
from touchline.functions.timefns import elapsed

# Total order of a conversion's touchpoints: time first, then fields that
# identify a touchpoint row, so equal timestamps order the same way on
# every run.
TOUCH_ORDER = (
    "touchpoint_timestamp", "traffic_source", "session_id", "touchpoint_id",
    "traffic_medium", "traffic_campaign", "user_id",
)

CONVERSION_SIDE = (
    "conversion_id", "conversion_date", "conversion_datetime", "conversion_timestamp",
    "conversion_event", "conversion_value", "transaction_id", "user_pseudo_id", "user_id",
    "attribution_window_start", "attribution_window_end", "conversion_channel",
    "device_category", "country",
)
TOUCH_SIDE = (
    "touchpoint_id", "touchpoint_date", "touchpoint_datetime", "touchpoint_timestamp",
    "channel", "traffic_source", "traffic_medium", "traffic_campaign", "landing_page",
    "is_direct_traffic", "session_id", "user_id",
)

JOURNEY_COLUMNS = (
    "journey_id", "conversion_id", "conversion_date", "conversion_datetime",
    "conversion_timestamp", "conversion_event", "conversion_value", "transaction_id",
    "user_pseudo_id", "user_id", "touchpoint_id", "touchpoint_date", "touchpoint_datetime",
    "touchpoint_timestamp", "channel", "traffic_source", "traffic_medium", "traffic_campaign",
    "landing_page", "is_direct_traffic", "touchpoint_position", "total_touchpoints",
    "days_to_conversion", "hours_to_conversion", "is_in_attribution_window",
    "conversion_channel", "conversion_device", "conversion_country",
    "is_first_touchpoint", "is_last_touchpoint", "journey_type", "journey_length_days",
)


def _day_bucket(ts: Column, bucket_days: int) -> Column:
    return F.floor(F.unix_date(F.to_date(ts)) / F.lit(bucket_days)).cast("int")


def _touch_side() -> list[Column]:
    return [F.col(x).alias(f"tp_{x}") if x in ("user_id", "session_id") else F.col(x) for x in TOUCH_SIDE]


def journey_pairs(conversions: DataFrame, touchpoints: DataFrame, bucket_days: int = 1,
                  conversion_cols: tuple[str, ...] = CONVERSION_SIDE) -> DataFrame:
    """All (conversion, touchpoint) pairs of the same user with
    ``window_start <= touch_datetime <= window_end`` and
    ``touch_timestamp < conversion_timestamp``.

    Output columns: ``conversion_cols``, the touch side prefixed ``tp_``
    where names clash, plus ``days_to_conversion`` / ``hours_to_conversion``.
    """
    if bucket_days < 1:
        raise ValueError("bucket_days must be >= 1")
    c = conversions.select(*conversion_cols).withColumn(
        "_bucket",
        F.explode(F.sequence(_day_bucket(F.col("attribution_window_start"), bucket_days),
                             _day_bucket(F.col("attribution_window_end"), bucket_days))),
    )
    t = touchpoints.select(
        F.col("user_pseudo_id").alias("_t_user"),
        *_touch_side(),
    ).withColumn("_bucket", _day_bucket(F.col("touchpoint_datetime"), bucket_days))
    cond = (
        (c["user_pseudo_id"] == t["_t_user"])
        & (c["_bucket"] == t["_bucket"])
        & (t["touchpoint_timestamp"] < c["conversion_timestamp"])
        & (t["touchpoint_datetime"] >= c["attribution_window_start"])
        & (t["touchpoint_datetime"] <= c["attribution_window_end"])
    )
    pairs = c.join(t, cond, "inner").drop(c["_bucket"]).drop(t["_bucket"]).drop("_t_user")
    return _with_distances(pairs)


def _with_distances(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns({
        "days_to_conversion": elapsed("day", "touchpoint_datetime", "conversion_datetime"),
        "hours_to_conversion": elapsed("hour", "touchpoint_datetime", "conversion_datetime"),
    })


def touch_order(prefix_map: dict | None = None) -> list[Column]:
    """Sort keys of :data:`TOUCH_ORDER` on the pairs table."""
    names = {"session_id": "tp_session_id", "user_id": "tp_user_id"}
    if prefix_map:
        names.update(prefix_map)
    return [F.col(names.get(c, c)).asc_nulls_first() for c in TOUCH_ORDER]


def journey_type(total: Column) -> Column:
    return (
        F.when(total == 1, "Single Touch")
        .when(total == 2, "Two Touch")
        .when(total <= 5, "Short Journey (3-5)")
        .when(total <= 10, "Medium Journey (6-10)")
        .otherwise("Long Journey (10+)")
    )


def rank_touches(touchpoints: DataFrame, rank_bucket_minutes: int = 1440) -> DataFrame:
    """Add ``user_touch_rank``: the 1-based position of each touchpoint among
    all touchpoints of its user, in :data:`TOUCH_ORDER`.

    Two levels keep every task bounded: a row number inside each
    (user, time bucket) group, plus the number of the user's touchpoints in
    earlier buckets.  That offset comes from a small per-(user, bucket)
    count table whose per-user window has at most one row per bucket.
    """
    bucket_micros = rank_bucket_minutes * 60 * 1_000_000
    tp = touchpoints.withColumn(
        "_rb", F.floor(F.col("touchpoint_timestamp") / F.lit(bucket_micros)).cast("bigint"))
    order = [F.col(c).asc_nulls_first() for c in TOUCH_ORDER]
    local = Window.partitionBy("user_pseudo_id", "_rb").orderBy(*order)
    tp = tp.withColumn("_local_rank", F.row_number().over(local))
    # Bucket sizes = the largest local rank; reading the windowed rows keeps
    # the same exchange, so Spark reuses it instead of recomputing.
    counts = tp.groupBy("user_pseudo_id", "_rb").agg(F.max("_local_rank").cast("bigint").alias("_n"))
    earlier = Window.partitionBy("user_pseudo_id").orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    ranked = tp.join(offsets.select("user_pseudo_id", "_rb", "_offset"), ["user_pseudo_id", "_rb"])
    return ranked.withColumn("user_touch_rank", (F.col("_offset") + F.col("_local_rank")).cast("bigint")) \
        .drop("_rb", "_local_rank", "_offset")


# Order of rows that share a conversion id (replays of one conversion), so that
# every plan picks the same row for the first and the last touch.
COPY_ORDER = tuple(c for c in CONVERSION_SIDE if c != "conversion_id")


def number_copies(conversions: DataFrame) -> DataFrame:
    """Add ``_copy`` (1-based) and ``_copies``: a conversion id may come more
    than once, and its journey then holds every touch once per copy.

    Equal rows are counted first (combined map-side), so only the different
    rows of one id meet, and each is then repeated as often as it came."""
    columns = conversions.columns
    ordered = [*COPY_ORDER, *[c for c in columns if c not in COPY_ORDER and c != "conversion_id"]]
    counted = conversions.groupBy(*columns).agg(F.count(F.lit(1)).alias("_m"))
    variants = counted.groupBy("conversion_id").agg(
        F.sort_array(F.collect_list(F.struct(*ordered, "_m"))).alias("_v"), F.sum("_m").alias("_copies"))
    each = variants.select("conversion_id", "_copies", F.posexplode("_v").alias("_at", "_row"), "_v")
    before = F.aggregate(F.slice("_v", F.lit(1), F.col("_at")), F.lit(0).cast("bigint"), lambda n, x: n + x["_m"])
    rows = each.select("conversion_id", "_row", "_copies", before.alias("_before"))
    rows = rows.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_row._m"))))
    return rows.select(*[F.col(c) if c == "conversion_id" else F.col(f"_row.{c}").alias(c) for c in columns],
                       (F.col("_before") + F.col("_nth")).alias("_copy"), "_copies")


def _finish(j: DataFrame, audit: bool) -> DataFrame:
    j = j.withColumns({
        "journey_id": dash_id("conversion_id", "touchpoint_id"),
        "is_in_attribution_window": F.col("touchpoint_datetime") >= F.col("attribution_window_start"),
        "conversion_device": F.col("device_category"),
        "conversion_country": F.col("country"),
        "is_first_touchpoint": F.col("touchpoint_position") == 1,
        "is_last_touchpoint": F.col("touchpoint_position") == F.col("total_touchpoints"),
        "journey_type": journey_type(F.col("total_touchpoints")),
    })
    out = [F.col(c) for c in JOURNEY_COLUMNS]
    if audit:
        out.insert(28, F.current_timestamp().alias("_updated_at"))
    return j.select(*out)


# Columns that tell which touches are a conversion id's; the windowed plan pairs only these.
PAIR_SIDE = ("conversion_id", "user_pseudo_id", "conversion_timestamp", "conversion_datetime",
             "attribution_window_start", "attribution_window_end")
# Ranks in one slice of a user's touches (fixed value): most journeys lie in one or two.
RANK_SLICE = 256


def journey_spans(conversions: DataFrame, ranked: DataFrame, rank_bucket_minutes: int = 1440) -> DataFrame:
    """conversion_id, ``_first_rank``, ``_last_rank``, ``_first_at``: the run of its user's touch ranks that
    is a conversion's journey, and the first touch's time (microseconds); ids without a touch are absent.

    Each conversion id puts two markers among its user's touches, at its window's start and at its end.
    Before a marker is the largest rank in its (user, time bucket), or else in the buckets before, after it
    the next touch likewise; only ids, times and ranks are shuffled, and no task holds a whole user.
    """
    bucket_micros = rank_bucket_minutes * 60 * 1_000_000
    ids = conversions.groupBy("conversion_id").agg(
        F.min("user_pseudo_id").alias("user_pseudo_id"), F.min(F.unix_micros("attribution_window_start")).alias("_start"),
        F.min(F.least(F.col("conversion_timestamp"), F.unix_micros("attribution_window_end") + 1)).alias("_end"))
    markers = ids.select("user_pseudo_id", "conversion_id", F.explode(F.array(
        F.struct(F.col("_start").alias("_ts"), F.lit(True).alias("_is_start")),
        F.struct(F.col("_end").alias("_ts"), F.lit(False).alias("_is_start")),
    )).alias("_m")).select("user_pseudo_id", "conversion_id", "_m.*")
    touches = ranked.select("user_pseudo_id", F.col("touchpoint_timestamp").alias("_ts"), F.col("user_touch_rank").alias("_rank"))
    both = touches.unionByName(markers, allowMissingColumns=True).withColumn(
        "_rb", F.floor(F.col("_ts") / F.lit(bucket_micros)).cast("bigint"))
    is_touch = F.col("_rank").isNotNull()
    # At one instant markers come first: a window holds its start and not its end.
    bucket, so_far = Window.partitionBy("user_pseudo_id", "_rb"), (Window.unboundedPreceding, 0)
    seen = both.withColumns({
        "_upto": F.max("_rank").over(bucket.orderBy("_ts", is_touch).rowsBetween(*so_far)),
        "_next": F.min(F.when(is_touch, F.col("_ts"))).over(bucket.orderBy(F.desc("_ts"), is_touch.desc()).rowsBetween(*so_far)),
    })
    sizes = seen.groupBy("user_pseudo_id", "_rb").agg(F.max("_rank").alias("_last"), F.min(F.when(is_touch, F.col("_ts"))).alias("_first"))
    user, others = Window.partitionBy("user_pseudo_id"), (Window.unboundedPreceding, -1)
    around = sizes.select("user_pseudo_id", "_rb", F.max("_last").over(user.orderBy("_rb").rowsBetween(*others)).alias("_before"),
                          F.min("_first").over(user.orderBy(F.desc("_rb")).rowsBetween(*others)).alias("_after"))
    placed = seen.where(~is_touch).join(around, ["user_pseudo_id", "_rb"]).select(
        "conversion_id", "_is_start", F.coalesce("_upto", "_before", F.lit(0)).alias("_rank"), F.coalesce("_next", "_after").alias("_next"))
    return placed.groupBy("conversion_id").agg(
        (F.max(F.when(F.col("_is_start"), F.col("_rank"))) + 1).alias("_first_rank"),
        F.max(F.when(~F.col("_is_start"), F.col("_rank"))).alias("_last_rank"),
        F.max(F.when(F.col("_is_start"), F.col("_next"))).alias("_first_at"),
    ).where("_last_rank >= _first_rank")


def user_journeys(conversions: DataFrame, touchpoints: DataFrame, bucket_days: int = 1,
                  audit: bool = False, plan: str = "ranked", rank_bucket_minutes: int = 1440) -> DataFrame:
    """Row-level journeys with position, size and first/last flags.

    ``plan="ranked"`` (default) never sorts a whole journey in one task and
    never shuffles pairs: a journey is a contiguous run of its user's
    touchpoints (both window bounds depend on time only), so with ``n`` copies
    of the conversion the touch of copy ``k`` has
    ``position = (user_touch_rank - first rank of the journey) * n + k``.
    The run and the longest distance are known beforehand (see
    :func:`journey_spans`); conversions and touches then meet by user and
    slice of :data:`RANK_SLICE` ranks, which gives the pairs and nothing else.

    ``touchpoints`` may already carry ``user_touch_rank`` (see
    :func:`rank_touches`); that table is read twice, so it pays to
    materialise it first.

    ``plan="windowed"`` is the direct form: ``row_number`` / ``count`` /
    ``max`` over a window partitioned by conversion.  Only the touch side of
    the pairs goes through the window's shuffle, once for each conversion id;
    the conversions (all copies) join its rows where they are.
    """
    conversions = conversions.select(*CONVERSION_SIDE)
    if plan == "windowed":
        ids = conversions.groupBy("conversion_id").agg(*[F.min(c).alias(c) for c in PAIR_SIDE if c != "conversion_id"])
        pairs = journey_pairs(ids, touchpoints, bucket_days, PAIR_SIDE)
        pairs = pairs.drop(*[c for c in PAIR_SIDE if c != "conversion_id"], "hours_to_conversion")
        by_conv = Window.partitionBy("conversion_id")
        placed = pairs.withColumns({
            "_nth": F.row_number().over(by_conv.orderBy(*touch_order())),
            "_touches": F.count(F.lit(1)).over(by_conv),
            "journey_length_days": F.max("days_to_conversion").over(by_conv),
        }).drop("days_to_conversion")
        j = placed.join(number_copies(conversions), "conversion_id").withColumns({
            "touchpoint_position": ((F.col("_nth") - 1) * F.col("_copies") + F.col("_copy")).cast("bigint"),
            "total_touchpoints": F.col("_touches") * F.col("_copies"),
        })
        return _finish(_with_distances(j), audit)
    if plan != "ranked":
        raise ValueError("plan must be 'ranked' or 'windowed'")
    ranked = touchpoints if "user_touch_rank" in touchpoints.columns \
        else rank_touches(touchpoints, rank_bucket_minutes)

    def rank_slice(rank: str) -> Column:
        return F.floor(F.col(rank) / F.lit(RANK_SLICE))

    c = number_copies(conversions).join(journey_spans(conversions, ranked, rank_bucket_minutes), "conversion_id").withColumns({
        "total_touchpoints": (F.col("_last_rank") - F.col("_first_rank") + 1) * F.col("_copies"),
        # The first touch is the farthest from the conversion.
        "journey_length_days": elapsed("day", F.timestamp_micros("_first_at"), "conversion_datetime"),
    }).withColumn("_slice", F.explode(F.sequence(rank_slice("_first_rank"), rank_slice("_last_rank"))))
    t = ranked.select(F.col("user_pseudo_id").alias("_t_user"), *_touch_side(), "user_touch_rank",
                      rank_slice("user_touch_rank").alias("_t_slice"))
    j = c.join(t, (F.col("user_pseudo_id") == F.col("_t_user")) & (F.col("_slice") == F.col("_t_slice"))
               & F.col("user_touch_rank").between(F.col("_first_rank"), F.col("_last_rank")))
    j = j.withColumn("touchpoint_position", ((F.col("user_touch_rank") - F.col("_first_rank")) * F.col("_copies") + F.col("_copy")).cast("bigint"))
    return _finish(_with_distances(j), audit)
