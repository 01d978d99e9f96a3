"""Tables kept in hash buckets of their key: an upsert reads and replaces only the buckets it touches.

A table is a folder partitioned by ``__of`` (its number of buckets, fixed when it is made) and
``__bucket`` (hash of the key modulo that number). The incoming rows tell which buckets they fall in; partition pruning
reads those alone, and a dynamic partition overwrite replaces them. Untouched buckets keep their files, and
no earlier version of the table stays behind.

The merged buckets are written beside the table first (``_pending``) and put in place from there, so that a writer that dies in
between loses nothing: the next writer puts a complete pending write in place before its own. Loading the same rows
again changes nothing. A table has one writer at a time; a reader that runs while buckets are
being replaced may fail on a missing file and is simply run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstick.operators.upsert import upsert
from yardstick.session import drop_stored, on_path, stored

OF, BUCKET = "__of", "__bucket"


def bucket_of(schema, keys: Sequence[str], buckets: int) -> Column:
    """A row's bucket; key columns are hashed in the table's types, so that a load with an int key meets its long."""
    return F.pmod(F.xxhash64(*[F.col(k).cast(schema[k].dataType) for k in keys]), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, mode: str, **options) -> None:
    """One file a bucket: the rows of a bucket meet in one task before they are written."""
    df.repartition(OF, BUCKET).write.mode(mode).options(**options).partitionBy(OF, BUCKET).parquet(path)


def create_buckets(df: DataFrame, root: str, keys: Sequence[str], buckets: int) -> None:
    """Make a table of ``buckets`` buckets from ``df`` (unique on ``keys``), replacing what is there.

    Choose the number so that a bucket is a file or two (256 MB to 1 GB): an upsert rewrites whole buckets.
    """
    spark = df.sparkSession
    if on_path(spark, f"{root}/_pending", "exists"):
        on_path(spark, f"{root}/_pending", "delete", True)
    rows = df.withColumns({OF: F.lit(buckets), BUCKET: bucket_of(df.schema, keys, buckets)})
    _write(rows, root, "overwrite", partitionOverwriteMode="static")


def read_buckets(spark: SparkSession, root: str) -> DataFrame:
    """The table's rows, without the bucket columns."""
    return spark.read.parquet(root).drop(OF, BUCKET)


def _put_in_place(spark: SparkSession, root: str) -> None:
    """Replace the table's buckets by those of a complete pending write, which then goes."""
    pending = f"{root}/_pending"
    if not on_path(spark, f"{pending}/_SUCCESS", "exists"):
        return
    _write(spark.read.parquet(pending), root, "overwrite", partitionOverwriteMode="dynamic")
    on_path(spark, pending, "delete", True)


def upsert_buckets(spark: SparkSession, root: str, incoming: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
                   order_cols: Sequence[str]) -> list[int]:
    """Upsert ``incoming`` into the table at ``root``; returns the buckets that were replaced.

    As ``operators.upsert``: existing keys change only ``update_cols`` (last arrival in ``order_cols``), new keys are
    inserted from their first arrival. The incoming rows are written once as a scratch table, as they are read for their
    buckets and for the merge. What comes to the driver is the list of buckets, at most as many as the table has.
    """
    root = root.rstrip("/")
    _put_in_place(spark, root)
    table = spark.read.parquet(root)
    buckets = table.select(OF).first()
    if buckets is None:
        raise ValueError(f"{root} holds no rows; make it by create_buckets")
    buckets = buckets[0]
    loaded = stored(incoming.withColumn(BUCKET, bucket_of(table.schema, keys, buckets)), "incoming")
    touched = sorted(r[0] for r in loaded.select(BUCKET).distinct().collect())
    if touched:
        current = table.where(F.col(BUCKET).isin(touched)).drop(OF, BUCKET)
        merged = upsert(current, loaded.drop(BUCKET), keys, update_cols, order_cols)
        merged = merged.withColumns({OF: F.lit(buckets), BUCKET: bucket_of(table.schema, keys, buckets)})
        _write(merged, f"{root}/_pending", "overwrite", partitionOverwriteMode="static")
        _put_in_place(spark, root)
    drop_stored(loaded)
    return touched
