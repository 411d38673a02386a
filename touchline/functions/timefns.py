"""Time helpers: whole elapsed units and window bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def elapsed(unit: str, start: Column | str, end: Column | str) -> Column:
    """Whole ``unit``s from ``start`` to ``end``, truncated toward zero.

    Unlike ``datediff`` this does not count calendar boundaries: 47 hours
    is 1 day.
    """
    return F.timestamp_diff(unit.upper(), _c(start), _c(end))


def minus_days(ts: Column | str, days: int) -> Column:
    return _c(ts) - F.make_dt_interval(F.lit(days))


def yyyymmdd_to_date(s: Column | str) -> Column:
    """Parse a ``yyyyMMdd`` string.  NULL stays NULL; a malformed string is an
    error, whatever the session's ANSI setting, so no row loses its date."""
    text = _c(s)
    parsed = F.try_to_date(text, "yyyyMMdd")
    return F.when(text.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("not a yyyyMMdd date: "), text)).cast("date")).otherwise(parsed)


def as_of_column(as_of) -> Column:
    """``current_timestamp()`` unless a fixed instant is given."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(str(as_of)).cast("timestamp")
