"""Channel x conversion-date comparison of the two attribution marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPARISON_COLUMNS = (
    "channel", "conversion_date", "first_click_conversions", "first_click_revenue",
    "avg_journey_days_fc", "avg_touchpoints_fc", "last_click_conversions",
    "last_click_revenue", "avg_journey_days_lc", "avg_touchpoints_lc",
    "conversion_shift", "revenue_shift", "conversion_shift_percent", "revenue_shift_percent",
)


def _per_channel_day(mart: DataFrame, tag: str, short: str) -> DataFrame:
    return mart.groupBy(F.col("attributed_channel").alias("channel"), "conversion_date").agg(
        F.countDistinct("conversion_id").alias(f"{tag}_conversions"),
        F.sum("conversion_value").alias(f"{tag}_revenue"),
        F.avg("journey_length_days").alias(f"avg_journey_days_{short}"),
        F.avg("total_touchpoints").alias(f"avg_touchpoints_{short}"),
    )


def _shift_percent(last, first, first_raw):
    return F.when(first > 0, (last - first) / first_raw * 100)


def attribution_comparison(first: DataFrame, last: DataFrame, sort: bool = True) -> DataFrame:
    """Full outer join of per-(channel, date) aggregates of both marts."""
    f = _per_channel_day(first, "first_click", "fc")
    l = _per_channel_day(last, "last_click", "lc")
    j = f.join(l, ["channel", "conversion_date"], "full")
    fc = F.coalesce(F.col("first_click_conversions"), F.lit(0))
    lc = F.coalesce(F.col("last_click_conversions"), F.lit(0))
    fr = F.coalesce(F.col("first_click_revenue"), F.lit(0.0))
    lr = F.coalesce(F.col("last_click_revenue"), F.lit(0.0))
    out = j.select(
        "channel", "conversion_date",
        fc.alias("first_click_conversions"), fr.alias("first_click_revenue"),
        "avg_journey_days_fc", "avg_touchpoints_fc",
        lc.alias("last_click_conversions"), lr.alias("last_click_revenue"),
        "avg_journey_days_lc", "avg_touchpoints_lc",
        (lc - fc).alias("conversion_shift"),
        (lr - fr).alias("revenue_shift"),
        _shift_percent(lc, fc, F.col("first_click_conversions")).cast("double").alias("conversion_shift_percent"),
        _shift_percent(lr, fr, F.col("first_click_revenue")).alias("revenue_shift_percent"),
    )
    if sort:
        out = out.orderBy(F.col("conversion_date").desc(), F.col("channel").asc())
    return out


def _stacked(both: DataFrame) -> DataFrame:
    """Two rows per conversion: (model, attributed channel)."""
    return both.select(
        "conversion_id", "conversion_date", "conversion_value", "journey_length_days", "total_touchpoints",
        F.explode(F.array(
            F.struct(F.lit("fc").alias("m"), F.col("first_channel").alias("channel"), F.col("in_first").alias("belongs")),
            F.struct(F.lit("lc").alias("m"), F.col("last_channel").alias("channel"), F.col("in_last").alias("belongs")),
        )).alias("_a"),
    ).where("_a.belongs").select("_a.m", "_a.channel", "conversion_id", "conversion_date", "conversion_value",
             "journey_length_days", "total_touchpoints")


def _pick(model: str, col: str):
    return F.max(F.when(F.col("m") == model, F.col(col)))


def comparison_from_both(both: DataFrame, sort: bool = True) -> DataFrame:
    """The comparison from one per-conversion table holding both channels.

    Both models are aggregated in ONE grouped aggregate over (model,
    channel, date), and a small pivot replaces the full outer join.  The
    marts' shared upstream is computed once instead of once per model.
    """
    per = _stacked(both).groupBy("m", "channel", "conversion_date").agg(
        F.countDistinct("conversion_id").alias("n"),
        F.sum("conversion_value").alias("rev"),
        F.avg("journey_length_days").alias("days"),
        F.avg("total_touchpoints").alias("touches"),
    )
    wide = per.groupBy("channel", "conversion_date").agg(
        _pick("fc", "n").alias("_fn"), _pick("fc", "rev").alias("_fr"),
        _pick("fc", "days").alias("avg_journey_days_fc"), _pick("fc", "touches").alias("avg_touchpoints_fc"),
        _pick("lc", "n").alias("_ln"), _pick("lc", "rev").alias("_lr"),
        _pick("lc", "days").alias("avg_journey_days_lc"), _pick("lc", "touches").alias("avg_touchpoints_lc"),
    )
    fc = F.coalesce(F.col("_fn"), F.lit(0).cast("bigint"))
    lc = F.coalesce(F.col("_ln"), F.lit(0).cast("bigint"))
    fr = F.coalesce(F.col("_fr"), F.lit(0.0))
    lr = F.coalesce(F.col("_lr"), F.lit(0.0))
    out = wide.select(
        "channel", "conversion_date",
        fc.alias("first_click_conversions"), fr.alias("first_click_revenue"),
        "avg_journey_days_fc", "avg_touchpoints_fc",
        lc.alias("last_click_conversions"), lr.alias("last_click_revenue"),
        "avg_journey_days_lc", "avg_touchpoints_lc",
        (lc - fc).alias("conversion_shift"),
        (lr - fr).alias("revenue_shift"),
        _shift_percent(lc, fc, F.col("_fn")).cast("double").alias("conversion_shift_percent"),
        _shift_percent(lr, fr, F.col("_fr")).alias("revenue_shift_percent"),
    )
    if sort:
        out = out.orderBy(F.col("conversion_date").desc(), F.col("channel").asc())
    return out


def channel_breakdown_from_both(both: DataFrame) -> DataFrame:
    """Conversions and revenue per channel under both models, one aggregate."""
    per = _stacked(both).groupBy("m", "channel").agg(
        F.countDistinct("conversion_id").alias("n"), F.sum("conversion_value").alias("rev"))
    wide = per.groupBy("channel").agg(
        _pick("fc", "n").alias("_fn"), _pick("lc", "n").alias("_ln"),
        _pick("fc", "rev").alias("_fr"), _pick("lc", "rev").alias("_lr"))
    return wide.select(
        "channel",
        F.coalesce("_fn", F.lit(0).cast("bigint")).alias("first_click_conversions"),
        F.coalesce("_ln", F.lit(0).cast("bigint")).alias("last_click_conversions"),
        F.coalesce("_fr", F.lit(0.0)).alias("first_click_revenue"),
        F.coalesce("_lr", F.lit(0.0)).alias("last_click_revenue"),
    ).orderBy(F.col("last_click_conversions").desc(), F.col("channel"))
