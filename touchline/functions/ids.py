"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dash_id(*parts) -> Column:
    """``a-b-c`` built with ``concat``: NULL if any part is NULL."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit("-"))
        cols.append(_c(p).cast("string"))
    return F.concat(*cols)


def hashed_event_id(user: Column | str, event_name: Column | str, timestamp: Column | str) -> Column:
    """First 16 hex chars of sha256(``user-event-timestamp``): stable across resends."""
    return F.substring(F.sha2(dash_id(user, event_name, timestamp), 256), 1, 16)
