"""Connected components of a graph given by its links, as Spark joins.

Large-star and small-star steps in turn (Kiveris and others, 2014): every round links each
node to the smallest node it knows, until nothing changes.  Each round's links are a written
table, so no lineage grows and a lost executor costs one round at most.  Only two numbers a
round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: u > v. Each node's neighbours (the larger ones, or the smaller ones and itself) get its smallest."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.join(least, "u").select("v", "u", "m")
    if large:
        out = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) of all nodes that have a link.

    links: two columns u, v of one orderable type, either way round; links of a node
    to itself and nulls are dropped.
    """
    now = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "links")
    state = _state(now)
    while state[0]:
        now = materialize(_star(_star(now, large=True), large=False), "links")
        if (after := _state(now)) == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
