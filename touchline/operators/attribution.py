"""First-click / last-click attribution marts and linear credit.

Two equivalent plans:

* :func:`attribute` reads the row-level journeys: keep the first (or
  last) touch of each conversion, and left join the conversions with it; those
  that have no touch become their own channel with medium ``direct``.
* :func:`attribute_single_pass` needs one summary row per conversion id
  (first and last touch, count, length), by default from touch counts at the
  ends of each journey, without any pair; one left join with the
  conversions then yields both the attributed and the touch-less rows, and
  both marts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.timefns import elapsed
from touchline.operators.journeys import TOUCH_ORDER, journey_pairs, journey_type, number_copies

MODELS = {"first": "First-Click", "last": "Last-Click"}

MART_COLUMNS = (
    "conversion_id", "conversion_date", "conversion_datetime", "conversion_event",
    "conversion_value", "transaction_id", "user_pseudo_id", "attributed_channel",
    "attributed_source", "attributed_medium", "attributed_campaign",
    "attributed_landing_page", "attributed_touchpoint_date", "attributed_touchpoint_datetime",
    "total_touchpoints", "journey_type", "journey_length_days", "{model}_touch_to_conversion_days",
    "conversion_channel", "conversion_device", "conversion_country", "attribution_model",
)


def mart_columns(model: str) -> list[str]:
    return [c.format(model=model) for c in MART_COLUMNS]


def _check(model: str) -> str:
    if model not in MODELS:
        raise ValueError(f"model must be one of {sorted(MODELS)}")
    return MODELS[model]


def attribute(journeys: DataFrame, conversions: DataFrame, model: str = "first") -> DataFrame:
    """Mart from row-level journeys: the flagged touch of each conversion id, and
    conversions without one as their own channel (one left join, so the journeys are computed once)."""
    _check(model)
    flag = "is_first_touchpoint" if model == "first" else "is_last_touchpoint"
    touched = journeys.where(F.col(flag)).select(
        "conversion_id", F.struct(*_PAYLOAD).alias(f"_{model}"), "total_touchpoints", "journey_length_days")
    return attribute_from_summary(conversions, touched, model)


# Payload of the first and the last touch.
_PAYLOAD = (
    "channel", "traffic_source", "traffic_medium", "traffic_campaign", "landing_page",
    "touchpoint_date", "touchpoint_datetime", "days_to_conversion",
)


def _ordered_touch() -> Column:
    keys = [F.col({"session_id": "tp_session_id", "user_id": "tp_user_id"}.get(c, c)).alias(f"_k{i}")
            for i, c in enumerate(TOUCH_ORDER)]
    return F.struct(*keys, *[F.col(c).alias(c) for c in _PAYLOAD])


def conversion_touch_summary(conversions: DataFrame, touchpoints: DataFrame, bucket_days: int = 1,
                             plan: str = "markers", rank_bucket_minutes: int = 1440) -> DataFrame:
    """One row per conversion id with a touch: first and last touch, number of
    touches (times the copies of the conversion), longest distance in days.

    ``plan="markers"`` (default) forms no pairs: see :func:`_summary_from_markers`.
    ``plan="struct"`` reduces the pairs by min / max of an ordered struct.
    """
    if plan == "markers":
        return _summary_from_markers(conversions, touchpoints, rank_bucket_minutes)
    if plan != "struct":
        raise ValueError("plan must be 'markers' or 'struct'")
    pairs = journey_pairs(conversions, touchpoints, bucket_days)
    return pairs.groupBy("conversion_id").agg(
        F.min(_ordered_touch()).alias("_first"),
        F.max(_ordered_touch()).alias("_last"),
        F.count(F.lit(1)).alias("total_touchpoints"),
        F.max("days_to_conversion").alias("journey_length_days"),
    )


def _summary_from_markers(conversions: DataFrame, touchpoints: DataFrame, rank_bucket_minutes: int) -> DataFrame:
    """The summary without pairing conversions and touches.

    Each conversion id puts two markers among its user's touches, at its
    window's start and at its own time.  The number of touches before a
    marker is a running count in one (user, time bucket) plus the user's
    touches in earlier buckets, so work grows with touches plus conversions
    and no task holds a whole user.  Touches between the markers are the
    journey: the first has the start's count + 1 as its rank, the last the
    end's count, and both are fetched by (user, rank).
    """
    bucket_micros = rank_bucket_minutes * 60 * 1_000_000
    ids = conversions.groupBy("conversion_id").agg(
        F.min("user_pseudo_id").alias("user_pseudo_id"), F.min("conversion_timestamp").alias("_end"),
        F.min("conversion_datetime").alias("_at"), F.min(F.unix_micros("attribution_window_start")).alias("_start"),
        F.count(F.lit(1)).alias("_copies"))
    conv = F.struct("conversion_id", "_at", "_copies")
    markers = ids.select("user_pseudo_id", F.explode(F.array(
        F.struct(F.col("_start").alias("_ts"), F.lit(True).alias("_is_start"), conv.alias("_conv")),
        F.struct(F.col("_end").alias("_ts"), F.lit(False).alias("_is_start"), conv.alias("_conv")),
    )).alias("_m")).select("user_pseudo_id", "_m.*")
    payload = [c for c in _PAYLOAD if c != "days_to_conversion"]
    rest = [c for c in TOUCH_ORDER if c not in payload and c != "touchpoint_timestamp"]
    touches = touchpoints.select("user_pseudo_id", F.col("touchpoint_timestamp").alias("_ts"),
                                 F.struct(*payload, *rest).alias("_touch"))
    both = touches.unionByName(markers, allowMissingColumns=True).withColumn(
        "_rb", F.floor(F.col("_ts") / F.lit(bucket_micros)).cast("bigint"))
    is_touch = F.col("_touch").isNotNull()
    # At one instant markers come first: a window holds its start and not its end.
    local = Window.partitionBy("user_pseudo_id", "_rb").orderBy(
        "_ts", is_touch, *[F.col(f"_touch.{c}").asc_nulls_first() for c in TOUCH_ORDER if c != "touchpoint_timestamp"])
    counted = both.withColumn("_n", F.sum(is_touch.cast("bigint")).over(local.rowsBetween(Window.unboundedPreceding, 0)))
    sizes = counted.groupBy("user_pseudo_id", "_rb").agg(F.max("_n").alias("_size"))
    earlier = Window.partitionBy("user_pseudo_id").orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("user_pseudo_id", "_rb", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    placed = counted.join(offsets, ["user_pseudo_id", "_rb"]).withColumn("_rank", F.col("_before") + F.col("_n"))

    start = F.max(F.when(F.col("_is_start"), F.col("_rank")))
    end = F.max(F.when(~F.col("_is_start"), F.col("_rank")))
    spans = (placed.where("_conv IS NOT NULL").groupBy("_conv.conversion_id")
             .agg(F.first("user_pseudo_id").alias("_user"), F.first("_conv._at").alias("_at"), F.first("_conv._copies").alias("_copies"),
                  (start + 1).alias("_r_first"), end.alias("_r_last"))
             .where(F.col("_r_last") >= F.col("_r_first")))
    ranked = placed.where(is_touch)

    def touch(side: str) -> DataFrame:
        return ranked.select(F.col("user_pseudo_id").alias(f"_u{side}"), F.col("_rank").alias(f"_k{side}"), F.col("_touch").alias(f"_t{side}"))

    f, l = touch("_first"), touch("_last")
    j = (spans.join(f, (F.col("_user") == F.col("_u_first")) & (F.col("_r_first") == F.col("_k_first")))
         .join(l, (F.col("_user") == F.col("_u_last")) & (F.col("_r_last") == F.col("_k_last"))))

    def as_struct(side: str) -> Column:
        fields = [F.col(f"_t{side}.{c}").alias(c) for c in payload]
        return F.struct(*fields, elapsed("day", f"_t{side}.touchpoint_datetime", "_at").alias("days_to_conversion"))

    return j.select(
        "conversion_id", as_struct("_first").alias("_first"), as_struct("_last").alias("_last"),
        ((F.col("_r_last") - F.col("_r_first") + 1) * F.col("_copies")).alias("total_touchpoints"),
        # The first touch is the farthest from the conversion.
        elapsed("day", "_t_first.touchpoint_datetime", "_at").alias("journey_length_days"),
    )


def _with_summary(conversions: DataFrame, summary: DataFrame) -> DataFrame:
    """Conversions (all copies, numbered) with their id's summary."""
    return number_copies(conversions).join(summary, "conversion_id", "left")


def _attributed_row(model: str) -> Column:
    """A touched conversion id has one row: the copy whose touch is the first
    (or last) of all; an id without a touch keeps every copy."""
    return F.col("total_touchpoints").isNull() | (F.col("_copy") == (F.lit(1) if model == "first" else F.col("_copies")))


def attribute_from_summary(conversions: DataFrame, summary: DataFrame, model: str = "first") -> DataFrame:
    label = _check(model)
    side = "_first" if model == "first" else "_last"
    j = _with_summary(conversions, summary).where(_attributed_row(model))
    hit = F.col("total_touchpoints").isNotNull()

    def pick(field: str, fallback: Column) -> Column:
        return F.when(hit, F.col(f"{side}.{field}")).otherwise(fallback)

    total = F.coalesce(F.col("total_touchpoints"), F.lit(1).cast("bigint"))
    return j.select(
        "conversion_id", "conversion_date", "conversion_datetime", "conversion_event",
        "conversion_value", "transaction_id", "user_pseudo_id",
        pick("channel", F.col("conversion_channel")).alias("attributed_channel"),
        pick("traffic_source", F.col("conversion_traffic_source")).alias("attributed_source"),
        pick("traffic_medium", F.lit("direct")).alias("attributed_medium"),
        pick("traffic_campaign", F.lit(None).cast("string")).alias("attributed_campaign"),
        pick("landing_page", F.col("conversion_page")).alias("attributed_landing_page"),
        pick("touchpoint_date", F.col("conversion_date")).alias("attributed_touchpoint_date"),
        pick("touchpoint_datetime", F.col("conversion_datetime")).alias("attributed_touchpoint_datetime"),
        total.alias("total_touchpoints"),
        journey_type(total).alias("journey_type"),
        F.coalesce(F.col("journey_length_days"), F.lit(0).cast("bigint")).alias("journey_length_days"),
        pick("days_to_conversion", F.lit(0).cast("bigint")).alias(f"{model}_touch_to_conversion_days"),
        "conversion_channel",
        F.col("device_category").alias("conversion_device"),
        F.col("country").alias("conversion_country"),
        F.lit(label).alias("attribution_model"),
    )


def attribution_both(conversions: DataFrame, summary: DataFrame) -> DataFrame:
    """Both marts' channels and shared measures, one row per conversion row;
    ``in_first`` / ``in_last`` say which mart the row belongs to."""
    j = _with_summary(conversions, summary)
    hit = F.col("total_touchpoints").isNotNull()
    return j.select(
        "conversion_id", "conversion_date", "conversion_value", "user_pseudo_id",
        F.when(hit, F.col("_first.channel")).otherwise(F.col("conversion_channel")).alias("first_channel"),
        F.when(hit, F.col("_last.channel")).otherwise(F.col("conversion_channel")).alias("last_channel"),
        F.coalesce(F.col("total_touchpoints"), F.lit(1).cast("bigint")).alias("total_touchpoints"),
        F.coalesce(F.col("journey_length_days"), F.lit(0).cast("bigint")).alias("journey_length_days"),
        _attributed_row("first").alias("in_first"), _attributed_row("last").alias("in_last"),
    )


def attribute_single_pass(conversions: DataFrame, touchpoints: DataFrame, model: str = "first",
                          bucket_days: int = 1, plan: str = "markers") -> DataFrame:
    summary = conversion_touch_summary(conversions, touchpoints, bucket_days, plan)
    return attribute_from_summary(conversions, summary, model)


def linear_credit(journeys: DataFrame, by: tuple[str, ...] = ("channel",)) -> DataFrame:
    """Even credit: each touch gets ``conversion_value / total_touchpoints``."""
    return journeys.groupBy(*by).agg(
        F.sum(F.col("conversion_value") / F.col("total_touchpoints")).alias("total_attributed_value")
    )
