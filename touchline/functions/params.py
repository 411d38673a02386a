"""Key lookup in the repeated ``event_params`` key/value array.

``array_position`` over the extracted ``key`` array finds the first
match, and ``get`` reads the value at that slot (NULL when the key is
absent).  Both are ordinary expressions, so the lookup stays inside the
row and inside whole-stage codegen: no explode, no shuffle, no lambda.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VALUE_FIELDS = ("string_value", "int_value", "float_value")


def param(key: str, field: str = "int_value", params: str = "event_params",
          strict: bool = False) -> Column:
    """Value of ``key`` in ``params``: NULL when absent, first match otherwise.

    ``strict=True`` raises at run time when the key occurs more than once,
    which is what a scalar subquery over the array would do.
    """
    if field not in VALUE_FIELDS:
        raise ValueError(f"unknown param value field {field!r}")
    keys = F.col(f"{params}.key")
    pos = F.array_position(keys, F.lit(key))
    value = F.get(F.col(f"{params}.value.{field}"), (pos - 1).cast("int"))
    if strict:
        last = F.size(keys) - F.array_position(F.reverse(keys), F.lit(key)) + 1
        repeated = (pos > 0) & (last != pos)
        value = F.when(repeated, F.raise_error(F.lit(f"event param {key!r} occurs more than once"))).otherwise(value)
    return value
