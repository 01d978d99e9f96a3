"""Audit of consumed offsets (J4, J6): what is missing and what was delivered more than once.

Offsets of a partition are one long sequence, and there are few partitions: a window over one would be one task. They are cut into
blocks of BLOCK consecutive offsets; gaps and islands are found within blocks, and what touches the
edge of a block is put together from one row, or two, a block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 16
STREAM = ("topic", "partition")


def offset_audit(records: DataFrame, block: int = BLOCK) -> DataFrame:
    """topic, partition, kind, first_offset, last_offset, offsets, deliveries for records (topic, partition, offset).

    'missing': a range of offsets between the smallest and the largest one of its partition that never arrived
    (deliveries 0). 'redelivered': a range of consecutive offsets that arrived more than once (deliveries: how often in
    all). Rows without an offset are left out; a topic or partition may be NULL, and is one of its own.
    """
    seen = records.where(F.col("offset").isNotNull()).groupBy(*STREAM, "offset").agg(F.count(F.lit(1)).alias("n"))
    seen = seen.withColumn("block", F.floor(F.col("offset") / F.lit(block)).cast("long"))
    return _missing(seen).unionByName(_redelivered(seen.where("n > 1"), block))


def _missing(seen: DataFrame) -> DataFrame:
    inside = Window.partitionBy(*STREAM, "block").orderBy("offset")
    gaps = seen.select(*STREAM, F.lag("offset").over(inside).alias("before"), F.col("offset").alias("after"))
    edges = seen.groupBy(*STREAM, "block").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"))
    along = Window.partitionBy(*STREAM).orderBy("block")  # one row a block
    between = edges.select(*STREAM, F.lag("hi").over(along).alias("before"), F.col("lo").alias("after"))
    gaps = gaps.unionByName(between).where(F.col("after") > F.col("before") + 1)
    return gaps.select(*STREAM, F.lit("missing").alias("kind"), (F.col("before") + 1).alias("first_offset"),
                       (F.col("after") - 1).alias("last_offset"), (F.col("after") - F.col("before") - 1).alias("offsets"),
                       F.lit(0).cast("long").alias("deliveries"))


def _redelivered(twice: DataFrame, block: int) -> DataFrame:
    def islands(rows: DataFrame, by: tuple) -> DataFrame:
        """Ranges lo..hi that follow one another, put together (``by`` keeps a window small)."""
        along = Window.partitionBy(*STREAM, *by).orderBy("lo")
        new = (F.lag("hi").over(along) + 1 == F.col("lo"))
        rows = rows.withColumn("__new", F.when(F.coalesce(new, F.lit(False)), 0).otherwise(1))
        rows = rows.withColumn("__island", F.sum("__new").over(along))
        return rows.groupBy(*STREAM, *by, "__island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")).drop("__island")

    found = islands(twice.select(*STREAM, "block", F.col("offset").alias("lo"), F.col("offset").alias("hi"), "n"), ("block",))
    first = F.col("block") * F.lit(block)
    at_edge = (F.col("lo") == first) | (F.col("hi") == first + F.lit(block - 1))  # at most two a block
    whole = found.where(~at_edge).drop("block").unionByName(islands(found.where(at_edge).drop("block"), ()))
    return whole.select(*STREAM, F.lit("redelivered").alias("kind"), F.col("lo").alias("first_offset"), F.col("hi").alias("last_offset"),
                        (F.col("hi") - F.col("lo") + 1).alias("offsets"), F.col("n").cast("long").alias("deliveries"))
