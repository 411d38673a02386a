"""Credit of every touch of a journey, by channel, without pairing conversions and touches.

A conversion's value is shared among its touches by weight: alike (linear), or halving with every
``half_life_days`` between touch and conversion (time decay).  A channel's share needs only the sum of
its touches' weights inside the journey, and that is a difference of prefix sums:

* Within a (user, UTC day) the touches' weights are 2^(time since midnight / half-life), so they stay
  in [1, 2^(1 day / half-life)) whatever the date; running sums per channel are taken at two markers of
  each conversion, its window's start and its own time.
* Whole days in between come from the table of a user's day sums, each moved to the conversion's day by its
  own power of two.  The lookback bounds how many there are.

Exponents are thus never larger than the lookback.  Counts run beside the weights and decide which channels are
in a journey, so a difference of sums that should be zero can't leave a rest.  Work grows with touches plus
conversions; no task holds a user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.channels import CHANNELS

DAY_MICROS = 86_400_000_000


def _weights(touch: Column, channel: Column, amount: Column, channels: tuple[str, ...]) -> list[Column]:
    return [F.when(touch & (channel == c), amount).otherwise(F.lit(0).cast("double")) for c in channels]


def _added(a: Column, b: Column, factor: Column) -> Column:
    """Element by element, b times a factor is added to a."""
    return F.zip_with(a, b, lambda x, y: x + y * factor)


def journey_shares(conversions: DataFrame, touchpoints: DataFrame, lookback_days: int = 14, half_life_days: float | None = None,
                   channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """conversion_id, value, channel, share: one row for every channel of every journey; shares of a conversion sum to 1.

    half_life_days None: every touch has the same weight.  A conversion without a touch has no rows; an id that
    comes more than once has its rows' mean value, as when the copies' touches share one journey.  ``channels``
    must name all channels that touches have; another one is an error.
    """
    if half_life_days is not None and half_life_days <= 0:
        raise ValueError("half_life_days must be > 0")
    per_day = 0.0 if half_life_days is None else 1.0 / half_life_days  # halvings a day
    ids = conversions.groupBy("conversion_id").agg(
        F.min("user_pseudo_id").alias("user"), F.min("conversion_timestamp").alias("_end"),
        F.min(F.unix_micros("attribution_window_start")).alias("_start"), F.avg("conversion_value").alias("value"))
    markers = ids.select("user", "conversion_id", "value", F.explode(F.array(
        F.struct(F.col("_start").alias("ts"), F.lit(True).alias("is_start")),
        F.struct(F.col("_end").alias("ts"), F.lit(False).alias("is_start")))).alias("m")).select("user", "conversion_id", "value", "m.*")
    known = F.when(F.col("channel").isin(*channels), F.col("channel")).otherwise(
        F.raise_error(F.concat(F.lit("not a known channel: "), F.col("channel"))).cast("string"))
    touches = touchpoints.where("channel IS NOT NULL").select(F.col("user_pseudo_id").alias("user"), F.col("touchpoint_timestamp").alias("ts"), known.alias("channel"))
    both = touches.unionByName(markers, allowMissingColumns=True).withColumn("day", F.floor(F.col("ts") / DAY_MICROS))
    is_touch = F.col("conversion_id").isNull()
    weight = F.pow(F.lit(2.0), (F.col("ts") - F.col("day") * DAY_MICROS) / DAY_MICROS * per_day)
    # At one instant markers come first: a window holds its start and not its end.
    running = Window.partitionBy("user", "day").orderBy("ts", is_touch).rowsBetween(Window.unboundedPreceding, 0)
    counted = both.select("*", *[F.sum(x).over(running).alias(f"_{kind}{i}")
                                 for kind, amount in (("w", weight), ("n", F.lit(1.0)))
                                 for i, x in enumerate(_weights(is_touch, F.col("channel"), amount, channels))])
    sums = {kind: [F.col(f"_{kind}{i}") for i in range(len(channels))] for kind in "wn"}
    days = counted.groupBy("user", "day").agg(*[F.max(f"_{kind}{i}").alias(f"_{kind}{i}") for kind in "wn" for i in range(len(channels))])
    days = days.select("user", "day", *[F.array(*sums[kind]).alias(kind) for kind in "wn"])
    # The days before, as far as a journey reaches: at most lookback_days rows of one user.
    earlier = Window.partitionBy("user").orderBy("day").rangeBetween(-lookback_days, -1)
    before = days.withColumn("_past", F.collect_list(F.struct("day", "w", "n")).over(earlier))
    nothing = F.array_repeat(F.lit(0.0), len(channels))
    fading = F.aggregate("_past", nothing, lambda a, d: _added(a, d["w"], F.pow(F.lit(2.0), (d["day"] - F.col("day")) * per_day)))
    counts = F.aggregate("_past", nothing, lambda a, d: _added(a, d["n"], F.lit(1.0)))
    before = before.select("user", "day", fading.alias("_before_w"), counts.alias("_before_n"))
    at = (counted.where(~is_touch).select("user", "day", "conversion_id", "value", "is_start", *[F.array(*sums[kind]).alias(kind) for kind in "wn"])
          .join(before, ["user", "day"]))
    start, end = F.col("is_start"), ~F.col("is_start")
    spans = at.groupBy("conversion_id").agg(
        F.first("value").alias("value"),
        *[F.max(F.when(start, F.col(kind))).alias(f"_start_{kind}") for kind in "wn"],
        *[F.max(F.when(end, _added(F.col(kind), F.col(f"_before_{kind}"), F.lit(1.0)))).alias(f"_end_{kind}") for kind in "wn"])
    old = F.lit(2.0 ** (-lookback_days * per_day))
    shares = spans.select("conversion_id", "value", _added(F.col("_end_n"), F.col("_start_n"), F.lit(-1.0)).alias("n"),
                          _added(F.col("_end_w"), F.col("_start_w"), -old).alias("w"))
    shares = shares.withColumn("w", F.zip_with("w", "n", lambda w, n: F.when(n > 0, w).otherwise(0.0)))
    total = F.aggregate("w", F.lit(0.0), lambda a, w: a + w)
    names = F.array(*map(F.lit, channels))
    rows = shares.withColumn("_total", total).withColumn("_c", F.explode(F.arrays_zip(names.alias("channel"), F.col("w"), F.col("n"))))
    return rows.where("_c.n > 0").select("conversion_id", "value", F.col("_c.channel").alias("channel"), (F.col("_c.w") / F.col("_total")).alias("share"))


def credit_by_channel(shares: DataFrame) -> DataFrame:
    """channel, total_attributed_value: the conversions' values by their shares."""
    return shares.groupBy("channel").agg(F.sum(F.col("value") * F.col("share")).alias("total_attributed_value"))
