"""Session construction and the shared scratch location.

Library code never creates its own session; it takes the caller's. The
helpers here are for tests, the bench and the command line.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "yardstick",
                  event_log_dir: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("YARDSTICK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # per-call Python call-site capture for error contexts: ~8 extra driver
        # round trips per Column operation while plans are built; off for runs
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # remove checkpoint files once their DataFrames are garbage-collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_base(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - e.g. Spark Connect
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder; on a local master without one, a temporary folder is set (tests)."""
    base = checkpoint_base(spark)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="yardstick-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location, removed when the application ends."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/yardstick-{name}-{uuid.uuid4().hex}"
    on_path(spark, path, "deleteOnExit")
    return path


def on_path(spark: SparkSession, path: str, call: str, *args):
    """A call of the path's file system: on_path(spark, path, "exists"), on_path(spark, path, "delete", True)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return getattr(p.getFileSystem(spark._jsc.hadoopConfiguration()), call)(p, *args)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a scratch table and read it back: cuts lineage, and later reads prune columns.

    A lost executor costs a re-read of the table, not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def stored_buckets(parts: list[DataFrame], name: str, keys: list[str], buckets: int) -> DataFrame:
    """Write DataFrames of one schema, one after the other, to a scratch table in buckets of ``keys``, and read it back.

    Joins, windows and aggregates by ``keys`` (or by more columns than those) need no exchange over it. The table's entry
    in the session's catalogue is what tells Spark of the buckets.
    """
    spark, path = parts[0].sparkSession, scratch_path(parts[0].sparkSession, name)
    table = f"yardstick_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    for df in parts:
        df.write.mode("append").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out._scratch, out._table = path, table
    return out


def drop_stored(df: DataFrame | None) -> None:
    """Delete a table made by `stored` that no later plan reads."""
    path, table = getattr(df, "_scratch", None), getattr(df, "_table", None)
    if table:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    if path:
        on_path(df.sparkSession, path, "delete", True)
