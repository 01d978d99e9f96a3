"""Sharding by a two-pass external shuffle.

Pass 1 scatters the records uniformly into memory-sized buckets by a seeded hash of their key;
pass 2 Fisher-Yates shuffles each bucket in one task. The buckets laid end to end are a
uniform order of all records; cutting it into equal runs gives the shards, whose row counts
are at most one apart (law `rows`).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardstick.llm.common import may_be_in, partitions, table
from yardstick.session import scratch_path

SEED = 20_240_607
SHARDS = 8
ROWS_PER_BUCKET = 50_000
BYTES_PER_BUCKET = 64 << 20


def record_bytes(records: DataFrame) -> Column:
    """About what a record takes in memory: the bytes of its texts, and eight for any other column."""
    return sum((F.coalesce(F.octet_length(c), F.lit(0)) if isinstance(records.schema[c].dataType, (T.StringType, T.BinaryType)) else F.lit(8)
                for c in records.columns), F.lit(8)).cast("long")


def buckets_needed(records: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET, bytes_per_bucket: int = BYTES_PER_BUCKET) -> DataFrame:
    """One row: the number of buckets, by rows or by bytes, whichever needs more, and at least the shuffle partitions."""
    rows = F.ceil(F.count(F.lit(1)) / F.lit(rows_per_bucket))
    size = F.ceil(F.coalesce(F.sum(record_bytes(records)), F.lit(0)) / F.lit(bytes_per_bucket))
    return records.agg(F.greatest(rows, size, F.lit(partitions(records.sparkSession))).cast("long").alias("n"))


def external_shuffle(records: DataFrame, key: list[str], shards: int = SHARDS, seed: int = SEED,
                     rows_per_bucket: int = ROWS_PER_BUCKET, bytes_per_bucket: int = BYTES_PER_BUCKET) -> DataFrame:
    """Add shard (int, 0 to shards - 1) and slot (long, gapless from 0 in its shard) to every record.

    `key` names the columns that identify a record. The same records give the same order
    whatever their partitions. Bucket count: rows / rows_per_bucket or bytes / bytes_per_bucket, whichever is more, at least the
    shuffle partitions, so a bucket fits a task's memory at every size, of short records and of long ones. Rows alike in all key columns
    are interchangeable; where `key` names every column, each is spread with the number of its
    copy, so that even a record that makes up a third of the input scatters uniformly (with
    further columns, give a key that tells the records apart). A record that is alone moves once, a
    repeated one is counted where it lies and moves twice. Nulls are ordinary values.
    Empty input gives an empty result. Columns shard and slot of the input are replaced.
    """
    keep = [c for c in records.columns if c not in ("shard", "slot")]
    n_buckets = buckets_needed(records, rows_per_bucket, bytes_per_bucket).scalar()
    copies = records.select(*keep, F.xxhash64(F.lit(seed), *key).alias("__h"))
    if set(keep) == set(key):  # whole rows are keys: count copies before the scatter, then lay them out again
        again = copies.groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__h")
        may_repeat = may_be_in(again, "__h")  # only these rows move before the scatter
        alike = (copies.where(may_repeat).groupBy(*keep, "__h").agg(F.count(F.lit(1)).alias("__n"))
                 .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).drop("__n"))
        alike = alike.withColumn("__h", F.when(F.col("__copy") == 1, F.col("__h"))
                                 .otherwise(F.xxhash64("__h", "__copy"))).drop("__copy")
        copies = copies.where(~may_repeat).unionByName(alike)
    scattered = copies.withColumn("__bucket", F.pmod("__h", n_buckets))
    per = scattered.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    # one row per bucket: rows / rows_per_bucket of them
    laid = per.select("__bucket", F.sum("__n").over(Window.orderBy("__bucket")).alias("__end"), "__n",
                      F.sum("__n").over(Window.partitionBy()).alias("__total"))
    schema = records.select(*keep).schema
    names = keep
    out_schema = T.StructType([*schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def fisher_yates(group: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows
        sort = [("__h", "ascending")] + [(c, "ascending") for c in key]
        left = left.sort_by(sort)
        rng = np.random.default_rng([seed, group[0].as_py()])
        place = np.arange(n)
        rng.shuffle(place)  # Fisher-Yates
        total = right.column("__total")[0].as_py()
        at = right.column("__end")[0].as_py() - right.column("__n")[0].as_py() + place
        shard = at * shards // total
        slot = at - -(-shard * total // shards)
        out = pa.table([*(left.column(c) for c in names), pa.array(shard.astype(np.int32)),
                        pa.array(slot.astype(np.int64))], names=[*names, "shard", "slot"])
        return out.take(pa.array(np.argsort(place)))  # the bucket's records in their new order

    return (scattered.groupBy("__bucket").cogroup(laid.groupBy("__bucket"))
            .applyInArrow(fisher_yates, out_schema))


def write_shards(records: DataFrame, path: str, key: list[str], shards: int = SHARDS, seed: int = SEED,
                 rows_per_bucket: int = ROWS_PER_BUCKET, bytes_per_bucket: int = BYTES_PER_BUCKET) -> None:
    """Write whole records as parquet folders shard=0 ... with their slots; every bucket is shuffled and written by one task."""
    external_shuffle(records, key, shards, seed, rows_per_bucket, bytes_per_bucket).write.partitionBy("shard").parquet(path)


def op10_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, written whole into shards 0 to 7 under the law `rows`, and read back; a null text has size 1 and crc 0."""
    docs, path = table(spark, sf_dir, "documents"), scratch_path(spark, "shards")
    write_shards(docs, path, docs.columns)
    schema = T.StructType([*docs.schema.fields, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    back = spark.read.schema(schema).parquet(path)
    return back.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
