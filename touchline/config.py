"""Run parameters for the attribution models."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime


@dataclass(frozen=True)
class AttributionConfig:
    """Parameters the models read.

    ``lookback_days`` and ``conversion_events`` mirror the two project
    variables the models actually use.  ``session_timeout_minutes`` feeds
    the gap-based sessionizer.  ``as_of`` replaces "now" in the sane-time
    filter so runs are reproducible; ``None`` means ``current_timestamp()``.
    """

    lookback_days: int = 14
    conversion_events: tuple[str, ...] = ("purchase", "begin_checkout")
    session_timeout_minutes: int = 30
    min_event_time: str = "2020-01-01 00:00:00"
    as_of: datetime | str | None = None
    # Touchpoint grain: "session" groups as the model code does (8 keys);
    # "channel_day" keeps one touchpoint per user-channel-date as documented.
    touchpoint_grain: str = "session"
    # Drop repeated event ids before staging (batch dedup option).
    dedup_events: bool = False
    # Drop conversions with negative value.
    exclude_negative_revenue: bool = False
    # Shard range of the sharded scan (inclusive, yyyyMMdd); None = all.
    shard_range: tuple[str, str] | None = None
    # Strict param lookup: raise when a key occurs twice in one event.
    strict_params: bool = False
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.lookback_days < 0:
            raise ValueError("lookback_days must be >= 0")
        if self.touchpoint_grain not in ("session", "channel_day"):
            raise ValueError("touchpoint_grain must be 'session' or 'channel_day'")
        object.__setattr__(self, "conversion_events", tuple(self.conversion_events))


DEFAULT_CONFIG = AttributionConfig()
