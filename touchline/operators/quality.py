"""Declarative data-quality checks over the derived tables.

``run_checks`` scans each table once: keys to be unique or related and
whatever fails another check are stacked and aggregated by (check, key);
the result is one small DataFrame
``(table_name, check_name, column_name, failures)``.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.channels import CHANNELS


@dataclass(frozen=True)
class Check:
    table: str
    kind: str  # unique | not_null | accepted_values | relationships | expression
    column: str
    values: tuple = ()
    to_table: str | None = None
    to_column: str | None = None
    expr: str | None = None
    uses: tuple = ()  # further columns an expression check reads

    @property
    def name(self) -> str:
        return f"{self.kind}__{self.table}__{self.column}"


def _nn(table, *cols):
    return [Check(table, "not_null", c) for c in cols]


# The declared model tests (53).
MODEL_CHECKS: tuple[Check, ...] = tuple(
    [Check("stg_ga4_events", "unique", "event_id")]
    + _nn("stg_ga4_events", "event_id", "user_pseudo_id", "event_name", "event_datetime", "channel")
    + [Check("stg_ga4_events", "accepted_values", "channel", CHANNELS)]
    + _nn("stg_ga4_events", "session_id", "is_conversion_event")
    + [Check("stg_ga4_sessions", "unique", "session_id")]
    + _nn("stg_ga4_sessions", "session_id", "user_pseudo_id", "session_date", "session_channel",
          "session_duration_seconds")
    + [Check("stg_ga4_conversions", "unique", "conversion_id")]
    + _nn("stg_ga4_conversions", "conversion_id", "user_pseudo_id", "conversion_event")
    + [Check("stg_ga4_conversions", "accepted_values", "conversion_event",
             ("purchase", "begin_checkout", "add_to_cart"))]
    + _nn("stg_ga4_conversions", "attribution_window_start", "attribution_window_end")
    + [Check("int_touchpoints", "unique", "touchpoint_id")]
    + _nn("int_touchpoints", "touchpoint_id", "user_pseudo_id", "touchpoint_date", "channel")
    + [Check("int_user_journeys", "unique", "journey_id")]
    + _nn("int_user_journeys", "journey_id", "conversion_id")
    + [Check("int_user_journeys", "relationships", "conversion_id",
             to_table="stg_ga4_conversions", to_column="conversion_id")]
    + _nn("int_user_journeys", "touchpoint_id")
    + [Check("int_user_journeys", "relationships", "touchpoint_id",
             to_table="int_touchpoints", to_column="touchpoint_id")]
    + _nn("int_user_journeys", "touchpoint_position", "is_first_touchpoint", "is_last_touchpoint",
          "days_to_conversion")
    + [Check("mart_first_click_attribution", "unique", "conversion_id")]
    + _nn("mart_first_click_attribution", "conversion_id", "attributed_channel", "conversion_value",
          "attribution_model")
    + [Check("mart_first_click_attribution", "accepted_values", "attribution_model", ("First-Click",))]
    + [Check("mart_last_click_attribution", "unique", "conversion_id")]
    + _nn("mart_last_click_attribution", "conversion_id", "attributed_channel", "conversion_value",
          "attribution_model")
    + [Check("mart_last_click_attribution", "accepted_values", "attribution_model", ("Last-Click",))]
    + _nn("mart_attribution_comparison", "channel", "conversion_date", "first_click_conversions",
          "last_click_conversions")
)

# Documented custom checks: purchases carry revenue, sessions last < 24 h.
CUSTOM_CHECKS: tuple[Check, ...] = (
    Check("stg_ga4_conversions", "expression", "conversion_value",
          expr="conversion_event <> 'purchase' OR conversion_value > 0", uses=("conversion_event",)),
    Check("stg_ga4_sessions", "expression", "session_duration_seconds",
          expr="session_duration_seconds < 86400"),
)


def checked_columns(checks) -> dict[str, set]:
    """Columns each table must provide for ``checks`` (so a caller can
    materialise only those)."""
    need: dict[str, set] = {}
    for ch in checks:
        need.setdefault(ch.table, set()).update((ch.column, *ch.uses))
        if ch.kind == "relationships":
            need.setdefault(ch.to_table, set()).add(ch.to_column)
    return need


def violations(tables: dict[str, DataFrame], check: Check) -> DataFrame:
    """The failing rows (or values) of one check, for storing."""
    df = tables[check.table]
    c = F.col(check.column)
    if check.kind == "not_null":
        return df.where(c.isNull())
    if check.kind == "accepted_values":
        return df.where(~c.isin(*check.values)).groupBy(check.column).count()
    if check.kind == "expression":
        return df.where(~F.expr(check.expr))
    if check.kind == "unique":
        return df.where(c.isNotNull()).groupBy(check.column).agg(F.count(F.lit(1)).alias("n_records")) \
            .where(F.col("n_records") > 1)
    if check.kind == "relationships":
        parent = tables[check.to_table].select(F.col(check.to_column).alias("_parent_key"))
        return df.where(c.isNotNull()).join(parent, c == F.col("_parent_key"), "left_anti")
    raise ValueError(f"unknown check kind {check.kind!r}")


# Checks whose failures are whole rows; the others' are values.
ROW_KINDS = ("not_null", "expression")


def _fails(check: Check):
    """Whether a row of the checked table adds something to the stack (null: no)."""
    c = F.col(check.column)
    if check.kind == "expression":
        return ~F.expr(check.expr)
    if check.kind == "accepted_values":
        return ~c.isin(*check.values)
    return c.isNull() if check.kind == "not_null" else c.isNotNull()


def _stacked(df: DataFrame, own: list[tuple[int, Check]], parents: list[tuple[int, Check]]) -> DataFrame:
    """check, key, parents (0 or 1): what the rows of one table add to the stack.

    A row that fails a check as a whole becomes JSON once, whatever the number of checks, and other rows never:
    with the JSON in every check's expression the code is too large to be compiled."""
    rows = [F.coalesce(_fails(ch), F.lit(False)) for _, ch in own if ch.kind in ROW_KINDS]
    if rows:
        # The whole row, so that the stored failure tells which one it is.
        df = df.withColumn("_failing_row", F.when(reduce(lambda a, b: a | b, rows), F.to_json(F.struct(*df.columns))))
    marks = {2 * i: F.when(_fails(ch), F.col("_failing_row") if ch.kind in ROW_KINDS else F.col(ch.column).cast("string")) for i, ch in own}
    marks |= {2 * i + 1: F.col(ch.to_column).cast("string") for i, ch in parents}
    wide = df.select(*[m.alias(str(n)) for n, m in marks.items()])
    mark = F.col("_mark").cast("int")
    return wide.unpivot([], [F.col(f"`{n}`") for n in marks], "_mark", "_key").where(F.col("_key").isNotNull()).select(
        F.shiftright(mark, 1).alias("check"), F.col("_key").alias("key"), mark.bitwiseAND(1).alias("parents"))


def failing_keys(tables: dict[str, DataFrame], checks=MODEL_CHECKS) -> DataFrame:
    """check (its number), key, n_rows: every value, or row as JSON, that fails a check.

    Each table is scanned once: a row adds its keys of the unique and relationships checks, and what fails one
    of the other checks, to one stack for all tables, which is aggregated by (check, key) with
    map-side sums, so neither a hot key nor a column that is null throughout makes a large group.
    """
    stacks = []
    for name, df in tables.items():
        own = [(i, ch) for i, ch in enumerate(checks) if ch.table == name]
        parents = [(i, ch) for i, ch in enumerate(checks) if ch.kind == "relationships" and ch.to_table == name]
        if own or parents:
            stacks.append(_stacked(df, own, parents))
    kinds = {kind: [i for i, ch in enumerate(checks) if ch.kind == kind] for kind in ("unique", "relationships")}
    per_key = reduce(DataFrame.unionAll, stacks).groupBy("check", "key").agg(
        F.count_if(F.col("parents") == 0).alias("n_rows"), F.sum("parents").alias("n_parents"))
    fails = F.when(F.col("check").isin(kinds["unique"]), F.col("n_rows") > 1).when(
        F.col("check").isin(kinds["relationships"]), (F.col("n_parents") == 0)).otherwise(True)
    return per_key.where(fails).select("check", "key", "n_rows")


def _named(spark, checks) -> DataFrame:
    return spark.createDataFrame([(i, ch.table, ch.kind, ch.column) for i, ch in enumerate(checks)],
                                 "check int, table_name string, check_name string, column_name string")


def count_failures(failing: DataFrame, checks=MODEL_CHECKS) -> DataFrame:
    """One row for each check: table_name, check_name, column_name, failures (0 where all is well).

    Keys are counted for unique and accepted_values checks, rows for the others.
    """
    by_key = [i for i, ch in enumerate(checks) if ch.kind in ("unique", "accepted_values")]
    counts = failing.groupBy("check").agg(F.sum(F.when(F.col("check").isin(by_key), 1).otherwise(F.col("n_rows"))).alias("failures"))
    return _named(failing.sparkSession, checks).join(counts, "check", "left").select(
        "table_name", "check_name", "column_name", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"))


def run_checks(tables: dict[str, DataFrame], checks=MODEL_CHECKS) -> DataFrame:
    return count_failures(failing_keys(tables, checks), checks)


def store_failures(tables: dict[str, DataFrame], path: str, checks=MODEL_CHECKS) -> list[str]:
    """Write what fails, in one job: table_name, check_name, column_name, key, n_rows, one folder for each
    table and kind of check.  A run replaces what the run before stored.  Returns each check's folder, which
    is absent where nothing fails."""
    # The names go to the failures: joined by shuffle, all failures of a check would meet in one task.
    names = F.broadcast(_named(next(iter(tables.values())).sparkSession, checks))
    failing = failing_keys(tables, checks).join(names, "check").drop("check")
    failing.write.mode("overwrite").partitionBy("table_name", "check_name").parquet(path)
    return [os.path.join(path, f"table_name={ch.table}", f"check_name={ch.kind}") for ch in checks]


def read_failures(spark, path: str) -> DataFrame:
    """What store_failures wrote; empty if nothing failed."""
    return spark.read.schema("column_name string, key string, n_rows bigint, table_name string, check_name string").parquet(path)


def oracle_check_sql(check: Check, cte: dict[str, str]) -> str:
    """DuckDB SQL returning one row for ``check`` (used by the oracle)."""
    t, c = cte[check.table], check.column
    if check.kind == "not_null":
        f = f"(SELECT count(*) FROM {t} WHERE {c} IS NULL)"
    elif check.kind == "accepted_values":
        vals = ", ".join("'" + v.replace("'", "''") + "'" for v in check.values)
        f = f"(SELECT count(DISTINCT {c}) FROM {t} WHERE {c} NOT IN ({vals}))"
    elif check.kind == "expression":
        f = f"(SELECT count(*) FROM {t} WHERE NOT ({check.expr}))"
    elif check.kind == "unique":
        f = f"(SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"
    elif check.kind == "relationships":
        p = cte[check.to_table]
        f = (f"(SELECT count(*) FROM {t} ch WHERE ch.{c} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {p} pa WHERE pa.{check.to_column} = ch.{c}))")
    else:
        raise ValueError(check.kind)
    return (f"SELECT '{check.table}' AS table_name, '{check.kind}' AS check_name, "
            f"'{c}' AS column_name, CAST({f} AS BIGINT) AS failures")
