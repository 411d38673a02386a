"""The derived-table DAG, wired lazily.

``events -> {sessions, conversions, touchpoints}``,
``conversions + touchpoints -> journeys``,
``journeys + conversions -> first / last``, ``first + last -> comparison``.

Every attribute is a lazy DataFrame; nothing runs until an action.  The
marts default to the single-pass plan (no journey windows).  Call
:meth:`Models.materialize` to cut lineage at the staged events (read by
every model) with a checkpoint in the cluster's shared checkpoint folder.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from touchline.config import DEFAULT_CONFIG, AttributionConfig
from touchline.operators.attribution import (
    attribute, attribute_from_summary, attribution_both, conversion_touch_summary, linear_credit,
)
from touchline.operators.comparison import (
    attribution_comparison, channel_breakdown_from_both, comparison_from_both,
)
from touchline.operators.credit import credit_by_channel, journey_shares
from touchline.plans import serving
from touchline.operators.journeys import rank_touches, user_journeys
from touchline.operators.staging import stage_conversions, stage_events, stage_sessions
from touchline.operators.touchpoints import touchpoints
from touchline.session import materialize


class Models:
    """Lazily built derived tables over one raw event DataFrame."""

    def __init__(self, raw: DataFrame, cfg: AttributionConfig = DEFAULT_CONFIG,
                 bucket_days: int = 1, mart_plan: str = "single_pass", journey_plan: str = "ranked",
                 reuse: str = "checkpoint", mart_summary: str = "markers"):
        if mart_plan not in ("single_pass", "windowed"):
            raise ValueError("mart_plan must be 'single_pass' or 'windowed'")
        self.raw = raw
        self.cfg = cfg
        self.bucket_days = bucket_days
        self.mart_plan = mart_plan
        self.journey_plan = journey_plan
        if reuse not in ("checkpoint", "none"):
            raise ValueError("reuse must be 'checkpoint' or 'none'")
        self.reuse = reuse
        if mart_summary not in ("markers", "struct"):
            raise ValueError("mart_summary must be 'markers' or 'struct'")
        self.mart_summary = mart_summary
        self._events = None

    @property
    def events(self) -> DataFrame:
        if self._events is None:
            self._events = stage_events(self.raw, self.cfg)
        return self._events

    def materialize(self) -> "Models":
        """Write the staged events once as a table in the checkpoint folder."""
        self._events = materialize(self.events, "stg_events")
        for name in ("sessions", "conversions", "touchpoints", "ranked_touchpoints", "summary", "both", "journeys",
                     "first_click", "last_click", "comparison"):
            self.__dict__.pop(name, None)
        return self

    def materialize_shared(self) -> "Models":
        """Events, touchpoints and the mart summary written once each, for consumers that read most models."""
        self.materialize()
        for name in ("touchpoints", "summary"):
            self.__dict__[name] = materialize(getattr(self, name), name)
        return self

    @cached_property
    def sessions(self) -> DataFrame:
        return stage_sessions(self.events)

    @cached_property
    def conversions(self) -> DataFrame:
        return stage_conversions(self.events, self.cfg)

    @cached_property
    def touchpoints(self) -> DataFrame:
        return touchpoints(self.events, self.cfg.touchpoint_grain)

    @cached_property
    def ranked_touchpoints(self) -> DataFrame:
        """Touchpoints with their rank inside the user.  The ranked journey
        plan reads this table twice, so it is written once as a table in the
        checkpoint folder (shared storage; survives executor loss)."""
        ranked = rank_touches(self.touchpoints)
        if self.reuse == "checkpoint":
            ranked = materialize(ranked, "ranked_touchpoints")
        return ranked

    @cached_property
    def journeys(self) -> DataFrame:
        tps = self.ranked_touchpoints if self.journey_plan == "ranked" else self.touchpoints
        return user_journeys(self.conversions, tps, self.bucket_days, plan=self.journey_plan)

    @cached_property
    def summary(self) -> DataFrame:
        """Per conversion: first / last touch, count, longest distance.

        ``mart_summary="markers"`` (default) counts touches at both ends of
        every journey and forms no pairs; ``"struct"`` aggregates ordered
        structs over the pairs."""
        return conversion_touch_summary(self.conversions, self.touchpoints, self.bucket_days, self.mart_summary)

    def mart(self, model: str) -> DataFrame:
        if self.mart_plan == "windowed":
            return attribute(self.journeys, self.conversions, model)
        return attribute_from_summary(self.conversions, self.summary, model)

    def mart_totals(self) -> tuple[DataFrame, DataFrame]:
        """What the totals of the first- and last-click marts need: conversion_id, conversion_value, user_pseudo_id.

        Both marts hold every conversion once; only for ids that come more than once does it matter whether
        they are touched.  So touches are looked at for the users of those ids alone.
        """
        columns = ("conversion_id", "conversion_value", "user_pseudo_id")
        repeated = materialize(self.conversions.groupBy("conversion_id").count().where("count > 1").select("conversion_id"), "repeated")
        if repeated.isEmpty():
            return self.conversions.select(*columns), self.conversions.select(*columns)
        single = self.conversions.join(repeated, "conversion_id", "left_anti").select(*columns)
        many = self.conversions.join(repeated, "conversion_id", "left_semi")
        touches = self.touchpoints.join(many.select("user_pseudo_id").distinct(), "user_pseudo_id", "left_semi")
        summary = materialize(conversion_touch_summary(many, touches, self.bucket_days, self.mart_summary), "summary")
        return tuple(single.unionByName(attribute_from_summary(many, summary, x).select(*columns)) for x in ("first", "last"))

    @cached_property
    def first_click(self) -> DataFrame:
        return self.mart("first")

    @cached_property
    def last_click(self) -> DataFrame:
        return self.mart("last")

    @cached_property
    def both(self) -> DataFrame:
        """Per conversion: first- and last-click channel and journey measures."""
        return attribution_both(self.conversions, self.summary)

    @cached_property
    def comparison(self) -> DataFrame:
        if self.mart_plan == "single_pass":
            return comparison_from_both(self.both)
        return attribution_comparison(self.first_click, self.last_click)

    def channel_breakdown(self) -> DataFrame:
        if self.mart_plan == "single_pass":
            return channel_breakdown_from_both(self.both)
        return serving.channel_breakdown(self.first_click, self.last_click)

    def linear(self, by: tuple[str, ...] = ("channel",)) -> DataFrame:
        """Even credit; by channel it needs no journeys, only counts at their ends."""
        if by == ("channel",):
            return credit_by_channel(journey_shares(self.conversions, self.touchpoints, self.cfg.lookback_days))
        return linear_credit(self.journeys, by)

    def time_decay(self, half_life_days: float) -> DataFrame:
        return credit_by_channel(journey_shares(self.conversions, self.touchpoints, self.cfg.lookback_days, half_life_days))

    def materialized_tables(self, columns: dict[str, set] | None = None) -> dict[str, DataFrame]:
        """The derived tables, each written once as a table in the checkpoint
        folder, for consumers that read every table several times (the
        quality checks).

        Tables that feed other models (events, conversions, touchpoints,
        the mart summary) are written whole first, so everything downstream
        is computed from them once.  The leaf tables are narrowed to the
        columns a consumer reads (``columns``: table name -> column set)."""
        self.materialize()
        for name in ("conversions", "touchpoints", "summary"):
            self.__dict__[name] = materialize(getattr(self, name), name)
        out = {}
        for name, df in self.tables().items():
            if columns is not None and name not in columns:
                continue
            if name == "stg_ga4_events":
                out[name] = df
                continue
            keep = [c for c in df.columns if columns is None or c in columns[name]]
            out[name] = materialize(df.select(*keep), name)
        return out

    def tables(self) -> dict[str, DataFrame]:
        return {
            "stg_ga4_events": self.events,
            "stg_ga4_sessions": self.sessions,
            "stg_ga4_conversions": self.conversions,
            "int_touchpoints": self.touchpoints,
            "int_user_journeys": self.journeys,
            "mart_first_click_attribution": self.first_click,
            "mart_last_click_attribution": self.last_click,
            "mart_attribution_comparison": self.comparison,
        }
