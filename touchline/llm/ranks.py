"""Ranks in a total order, over all rows, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import materialize

REPEAT_BLOCK = 1 << 16


def ranked(df: DataFrame, order: list[str], group: str | None = None) -> DataFrame:
    """Adds rank: from 0, in each value of group (not null), by the columns of order and then by all others; nulls first.

    A name in order may start with "-" for descending (nulls last).  Equal rows are counted before the
    shuffle and repeated afterwards, so rows of one value aren't one task's; the rest is dealt out by ranges.
    A range's place comes from the sums of the ranges before it.
    """
    rest = [c for c in df.columns if c not in {x.lstrip("-") for x in order} and c != group]
    by = [F.col(x[1:]).desc_nulls_last() if x.startswith("-") else F.col(x).asc_nulls_first() for x in [*order, *rest]]
    unit = F.col(group) if group else F.lit(0)
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    dealt = counted.withColumn("_unit", unit).repartitionByRange(F.col("_unit"), *by).withColumn("_part", F.spark_partition_id())
    dealt = materialize(dealt, "ranges")
    sizes = dealt.groupBy("_unit", "_part").agg(F.sum("_copies").alias("_size"))
    upto = Window.partitionBy("_unit").orderBy("_part")
    before = sizes.select("_unit", "_part", (F.sum("_size").over(upto) - F.col("_size")).alias("_before"))
    own = Window.partitionBy("_unit", "_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("_own", F.sum("_copies").over(own) - F.col("_copies")).join(before, ["_unit", "_part"])
    first = F.col("_before") + F.col("_own")
    last = first + F.col("_copies") - 1
    # Two steps, so that no array grows with the number of equal rows.
    blocks = placed.withColumns({"_last": last, "_at": F.explode(F.sequence(first, last, F.lit(REPEAT_BLOCK)))})
    ranks = F.sequence(F.col("_at"), F.least(F.col("_last"), F.col("_at") + REPEAT_BLOCK - 1))
    return blocks.withColumn("rank", F.explode(ranks)).select(*df.columns, "rank")
