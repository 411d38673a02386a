"""Spark session helpers.

On a cluster the session comes configured; these helpers only fill in
settings that are unset, so local tests get a sane UTC session with AQE
on and no UI.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stages whose generated method exceeds HotSpot's JIT limit fall back to
    # per-operator code instead of running interpreted bytecode.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Remove checkpoint files once their RDDs are garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "touchline", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TOUCHLINE_DRIVER_MEMORY", "16g"))
    )
    for k, v in {**LOCAL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Models compute calendar dates from UTC instants."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_small_methods(spark: SparkSession) -> None:
    """HotSpot never compiles a method above 8,000 bytes, and staged events come from one: a stage with such a
    method runs per operator instead, whose code is split.  A lower limit of the session stays."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > int(LOCAL_DEFAULTS[key]):
        spark.conf.set(key, LOCAL_DEFAULTS[key])


@contextmanager
def unset_filled_in(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Within the block, the settings hold that the session has not set itself."""
    missing = {key: value for key, value in settings.items() if spark.conf.get(key, None) is None}
    for key, value in missing.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in missing:
            spark.conf.unset(key)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir.

    Only in local mode, where driver and tasks share one disk, may the setting be
    absent; a fresh scratch folder is then made and registered.
    """
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = context.getCheckpointDir()
    if not path:
        if context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="touchline-ckpt-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


def materialize(df, name: str):
    """Write ``df`` once as a Parquet table under the checkpoint folder and
    return a reader over it.

    This cuts lineage like ``checkpoint()`` but computes the input once (an
    eager reliable checkpoint runs its input twice) and keeps columnar
    storage, so later readers prune columns and push filters down.
    """
    import uuid
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run, sized from the input and the cluster.

    * initial shuffle partitions: enough for ``target_partition_bytes`` per
      partition of the scanned input, and at least 2 per core, so no task
      holds an oversized share.  AQE then coalesces small partitions to the
      advisory size and splits skewed ones;
    * scan splits of the same size;
    * skew-join detection: a partition is skewed at 4x the median size and
      above 4x the target.  A hot (user, day) join key is split that way;
    * broadcast only sides under 64 MB by Spark's own size estimate (the
      planner checks the size; above it, sort-merge join).
    """
    cores = max(1, executors * cores_per_executor)
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
