"""Refresh of all eight derived tables after new or late events, published together.

What new events can change is followed through the models as a sparse set of (user, date):

* events and conversions of the new events' dates get rows appended;
* touchpoints are groups within one date: the new events' dates are computed again;
* a session is the events of its key wherever they are: the sessions of the new events' keys are computed
  again from the dates their stored rows span;
* a touch on date d can be in journeys of its user's conversions dated d to d + lookback: exactly
  those conversions get new journeys and mart rows, the other rows of their dates are kept;
* the comparison is summed again for the dates of those conversions.

Work is in proportion to what changed: partitions of other dates are neither read nor written.  The driver holds
lists of dates, never of users.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.config import DEFAULT_CONFIG, AttributionConfig
from touchline.operators.attribution import attribute_from_summary, conversion_touch_summary
from touchline.operators.comparison import attribution_comparison
from touchline.operators.journeys import rank_touches, user_journeys
from touchline.operators.staging import stage_conversions, stage_events, stage_sessions
from touchline.operators.touchpoints import touchpoints
from touchline.plans.models import Models
from touchline.session import materialize
from touchline.sources.snapshots import Generation

#: Every table's date column and what its files are sorted by.
TABLES = {
    "stg_ga4_events": ("event_date", ("event_name", "user_pseudo_id")),
    "stg_ga4_sessions": ("session_date", ("user_pseudo_id",)),
    "stg_ga4_conversions": ("conversion_date", ("user_pseudo_id",)),
    "int_touchpoints": ("touchpoint_date", ("user_pseudo_id",)),
    "int_user_journeys": ("conversion_date", ("conversion_id",)),
    "mart_first_click_attribution": ("conversion_date", ("attributed_channel",)),
    "mart_last_click_attribution": ("conversion_date", ("attributed_channel",)),
    "mart_attribution_comparison": ("conversion_date", ("channel",)),
}
#: Journeys are many times their inputs: their rows are written where the pairs were formed, not shuffled by date.
UNSHUFFLED = ("int_user_journeys",)
SESSION_KEY = ("session_id", "user_pseudo_id", "user_id")


def build_all(spark: SparkSession, root: str, raw: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG) -> int:
    """Writes all tables from raw events and publishes them; returns the generation's number."""
    g = Generation(spark, root)
    models = Models(raw, cfg).materialize()
    for name in ("conversions", "touchpoints", "summary"):  # read by several tables
        models.__dict__[name] = materialize(getattr(models, name), name)
    for name, df in models.tables().items():
        g.replace(name, df, *_at(name))
    return g.commit()


def _at(name: str, dates: set[str] | None = None) -> tuple:
    column, cluster_by = TABLES[name]
    return column, dates, cluster_by, name not in UNSHUFFLED


def _values(df: DataFrame, column: Column) -> set[str]:
    """The distinct dates in a column, as text: as many as days."""
    return {r[0] for r in df.select(column.cast("string")).distinct().collect() if r[0] is not None}


def _same(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def _days(start: str, end: str) -> Column:
    return F.explode(F.sequence(F.to_date(start), F.to_date(end)))


def refresh_all(spark: SparkSession, root: str, new_raw: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG) -> int | None:
    """Brings all tables up to date with new raw events (not yet stored ones) and publishes them together.

    Returns the generation's number, null when there are no new events.  Run again after a failure
    before the commit, it starts from the tables as they were.
    """
    g = Generation(spark, root)
    new = materialize(stage_events(new_raw, cfg), "new-events")
    new_dates = _values(new, F.col("event_date"))
    if not new_dates:
        return None
    day = F.to_date("event_date", "yyyyMMdd")
    changed = materialize(new.select("user_pseudo_id", day.alias("day")).distinct(), "changed")
    iso = {f"{d[:4]}-{d[4:6]}-{d[6:]}" for d in new_dates}

    # Sessions of the new events' keys, from the days that their stored rows span.
    keys = materialize(new.select(*SESSION_KEY).distinct(), "session-keys")
    stored = g.read("stg_ga4_sessions")
    old = materialize(stored.join(keys, _same(stored, keys, SESSION_KEY), "left_semi"), "old-sessions")
    spans = _values(old.select(_days("session_start_time", "session_end_time").alias("d")), F.date_format("d", "yyyyMMdd"))
    events = g.read("stg_ga4_events", spans)
    of_keys = events.join(keys, _same(events, keys, SESSION_KEY), "left_semi").unionByName(new)
    sessions = materialize(stage_sessions(of_keys), "new-sessions")
    at = _values(old, F.col("session_date")) | _values(sessions, F.col("session_date"))
    rest = g.read("stg_ga4_sessions", at)
    rest = rest.join(keys, _same(rest, keys, SESSION_KEY), "left_anti")
    g.replace("stg_ga4_sessions", rest.unionByName(sessions), *_at("stg_ga4_sessions", at))

    column, cluster_by = TABLES["stg_ga4_events"]
    g.append("stg_ga4_events", new, column, cluster_by)
    column, cluster_by = TABLES["stg_ga4_conversions"]
    g.append("stg_ga4_conversions", stage_conversions(new, cfg), column, cluster_by)
    g.replace("int_touchpoints", touchpoints(g.read("stg_ga4_events", new_dates), cfg.touchpoint_grain), *_at("int_touchpoints", iso))

    # The conversions whose journeys may have changed.
    reach = changed.select("user_pseudo_id", F.explode(F.sequence("day", F.date_add("day", cfg.lookback_days))).alias("conversion_date")).distinct()
    reach = materialize(reach, "reach")
    near = g.dates("stg_ga4_conversions") & _values(reach, F.col("conversion_date"))
    touched = materialize(g.read("stg_ga4_conversions", near).join(reach, ["user_pseudo_id", "conversion_date"], "left_semi"), "touched")
    dates = _values(touched, F.col("conversion_date"))
    back = _values(touched.select(F.explode(F.sequence(F.date_sub("conversion_date", cfg.lookback_days), "conversion_date")).alias("d")).distinct(), F.col("d"))
    users = touched.select("user_pseudo_id").distinct()
    touches = materialize(rank_touches(g.read("int_touchpoints", back).join(users, "user_pseudo_id", "left_semi")), "touches")
    # Rows that stay are told by user and date, one row a changed user: the stored rows needn't be shuffled for it.
    gone = materialize(changed.groupBy(F.col("user_pseudo_id").alias("_user")).agg(F.collect_set("day").alias("_days")), "changed-users")
    summary = materialize(conversion_touch_summary(touched, touches), "touched-summary")
    again = {
        "int_user_journeys": user_journeys(touched, touches),
        "mart_first_click_attribution": attribute_from_summary(touched, summary, "first"),
        "mart_last_click_attribution": attribute_from_summary(touched, summary, "last"),
    }
    for name, df in again.items():
        kept = g.read(name, dates)
        kept = kept.join(gone, (kept["user_pseudo_id"] == gone["_user"]) & F.exists(
            gone["_days"], lambda d: kept["conversion_date"].between(d, F.date_add(d, cfg.lookback_days))), "left_anti")
        g.replace(name, kept.unionByName(df), *_at(name, dates))
    first, last = (g.read(f"mart_{x}_click_attribution", dates) for x in ("first", "last"))
    g.replace("mart_attribution_comparison", attribution_comparison(first, last), *_at("mart_attribution_comparison", dates))
    return g.commit()
