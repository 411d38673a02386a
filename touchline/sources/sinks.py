"""Sinks: event table, views, partitioned marts, incremental refresh,
export / restore by date and retention (to a new path or in place).

All writes are Parquet directories (shared storage on a cluster); a
failed job leaves no partial output because each write commits as a
whole through the output committer.
"""

from __future__ import annotations

import os
import uuid
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _clustered(df: DataFrame, partition_col: str, cluster_by: tuple[str, ...], rebalance: bool = True) -> DataFrame:
    if not rebalance:
        return df.sortWithinPartitions(partition_col, *cluster_by)
    # Rebalancing gives small dates one file and splits large ones (also a
    # date that has most rows) at the advisory partition size.
    df = df.hint("rebalance", partition_col)
    return df.sortWithinPartitions(*cluster_by) if cluster_by else df


def ensure_event_table(spark: SparkSession, path: str, schema: T.StructType,
                       partition_col: str = "event_date") -> bool:
    """Create an empty table partitioned by ``partition_col`` if absent.
    Returns True when it was created.  Parquet has no file to hold the schema
    of an empty partitioned table: read it with :func:`read_event_table`."""
    if table_exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(partition_col).parquet(path)
    return True


def read_event_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` by its known schema; one without rows is empty."""
    return spark.read.schema(schema).parquet(path)


def write_clustered(df: DataFrame, path: str, partition_col: str, cluster_by: tuple[str, ...],
                    mode: str = "append", rebalance: bool = True) -> None:
    """Write partitioned by ``partition_col`` with rows sorted by
    ``cluster_by`` inside each file, so Parquet min/max statistics prune
    reads on those columns.  Rows of a date meet in tasks of about the
    advisory partition size, so files are few and no task gets a whole hot date.
    Without ``rebalance`` the rows stay in the tasks that made them, each of which writes a sorted
    file for every date it has: more files, but a table much wider than its inputs isn't shuffled."""
    _clustered(df, partition_col, cluster_by, rebalance).write.mode(mode).partitionBy(partition_col).parquet(path)


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """Expose each model as a temporary view (a view materialisation)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def write_mart(df: DataFrame, path: str, partition_col: str = "conversion_date",
               cluster_by: tuple[str, ...] = ("attributed_channel",)) -> None:
    """Full materialisation of a mart, partitioned by date."""
    cluster = tuple(c for c in cluster_by if c in df.columns)
    write_clustered(df, path, partition_col, cluster, mode="overwrite")


def write_incremental(df: DataFrame, path: str, partition_col: str,
                      cluster_by: tuple[str, ...] = ()) -> None:
    """Replace only the partitions present in ``df`` (dynamic partition
    overwrite); other dates stay as they are."""
    (_clustered(df, partition_col, cluster_by)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read a table whose later partitions may carry new columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def _day(d) -> date:
    if isinstance(d, datetime):
        return d.date()
    if isinstance(d, date):
        return d
    s = str(d)
    return datetime.strptime(s, "%Y%m%d").date() if len(s) == 8 else date.fromisoformat(s)


def export_partition(spark: SparkSession, table_path: str, day, out_dir: str,
                     partition_col: str = "conversion_date") -> str:
    """Copy one date partition to ``out_dir/<yyyyMMdd>`` (partition-pruned read)."""
    d = _day(day)
    target = os.path.join(out_dir, d.strftime("%Y%m%d"))
    spark.read.parquet(table_path).where(F.col(partition_col) == F.lit(d)) \
        .write.mode("overwrite").parquet(target)
    return target


def restore_partition(spark: SparkSession, export_path: str, table_path: str, day,
                      partition_col: str = "conversion_date") -> None:
    """Load an exported date back into the table (that date only).  The
    export keeps no partition column, so it is re-added from ``day``."""
    d = _day(day)
    df = spark.read.parquet(export_path)
    if partition_col not in df.columns:
        df = df.withColumn(partition_col, F.lit(d))
    write_incremental(df, table_path, partition_col)


def apply_retention(spark: SparkSession, path: str, out_path: str, days: int = 7, as_of=None,
                    ts_col: str = "ingestion_timestamp") -> DataFrame:
    """Keep rows whose ``date(ts_col)`` is within ``days`` of ``as_of`` and
    write them to a fresh path (no in-place delete); returns the kept rows."""
    today = _day(as_of) if as_of is not None else datetime.utcnow().date()
    cutoff = today - timedelta(days=days)
    kept = spark.read.parquet(path).where(F.to_date(ts_col) >= F.lit(cutoff))
    partition_cols = [c for c in ("event_date",) if c in kept.columns]
    w = kept.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(out_path)
    return spark.read.parquet(out_path)


def retain_in_place(spark: SparkSession, path: str, days: int = 7, as_of=None, ts_col: str = "ingestion_timestamp",
                    partition_col: str = "event_date") -> dict[str, list[str]]:
    """Delete rows of the table at ``path`` whose ``date(ts_col)`` is more than ``days`` before ``as_of``.

    One scan of ``ts_col`` alone tells what each date holds.  Dates of which every row is expired go as folders;
    a date with some expired rows is rewritten, first to a folder beside the table and from there by
    dynamic overwrite, whose commit swaps whole dates; all other dates keep their files.  Rows without
    a ``ts_col`` stay.  A run that failed is finished by the next one.  Returns the dates dropped and rewritten.
    """
    today = _day(as_of) if as_of is not None else datetime.utcnow().date()
    cutoff = F.lit(today - timedelta(days=days))
    table = spark.read.parquet(path)
    stays = F.coalesce(F.to_date(ts_col) >= cutoff, F.lit(True))
    held = table.groupBy(partition_col).agg(F.count_if(stays).alias("kept"), F.count_if(~stays).alias("expired")).where("expired > 0").collect()
    dropped = [r[0] for r in held if not r.kept]
    boundary = [r[0] for r in held if r.kept]
    if boundary:
        beside = f"{path.rstrip('/')}-retained-{uuid.uuid4().hex}"
        cut = reduce(Column.__or__, [F.col(partition_col).eqNullSafe(d) for d in boundary])
        table.where(cut & stays).write.partitionBy(partition_col).parquet(beside)
        # By the table's own schema: dates may be strings there.
        write_incremental(spark.read.schema(table.schema).parquet(beside), path, partition_col)
        _delete(spark, beside)
    for d in dropped:
        _delete(spark, os.path.join(path, f"{partition_col}={'__HIVE_DEFAULT_PARTITION__' if d is None else d}"))
    spark.catalog.refreshByPath(path)
    return {"dropped": sorted(map(str, dropped)), "rewritten": sorted(map(str, boundary))}


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
