"""Versioned parquet tables without a MERGE-capable format.

A table is a folder of versions ``<root>/v=<n>``; the current version is the
highest one whose write completed (``_SUCCESS`` present), so a failed or
interrupted write is never read and can simply be retried. An upsert reads the
current version, folds the incoming rows in (``operators.upsert``) and writes
version n+1; older versions stay readable until they are removed by retention.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from yardstick.operators.upsert import upsert


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def completed_versions(spark: SparkSession, root: str, prefix: str = "v=") -> list[int]:
    """Version numbers under ``root`` whose write completed (file-system listing only)."""
    jvm, p, fs = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix) and \
                fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name[len(prefix):]))
    return sorted(out)


def current_version(spark: SparkSession, root: str) -> tuple[DataFrame | None, int]:
    """(current table, its version) or (None, 0) for a table not written yet."""
    versions = completed_versions(spark, root)
    if not versions:
        return None, 0
    return spark.read.parquet(f"{root.rstrip('/')}/v={versions[-1]}"), versions[-1]


def write_version(df: DataFrame, root: str, version: int) -> str:
    """Write one version. A completed one is never replaced (a second writer fails); an interrupted one is."""
    path = f"{root.rstrip('/')}/v={version}"
    if version in completed_versions(df.sparkSession, root):
        raise FileExistsError(f"{path} is already written")
    df.write.mode("overwrite").parquet(path)
    return path


def upsert_into(spark: SparkSession, root: str, incoming: DataFrame, keys: Sequence[str],
                update_cols: Sequence[str], order_cols: Sequence[str]) -> int:
    """Upsert ``incoming`` into the table at ``root`` as a new version; returns it.

    Existing keys change only ``update_cols`` (last arrival in ``order_cols``);
    new keys are inserted from their first arrival.
    """
    current, version = current_version(spark, root)
    write_version(upsert(current, incoming, keys, update_cols, order_cols), root, version + 1)
    return version + 1
