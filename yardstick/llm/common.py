"""Helpers shared by the corpus operators: salted joins, distributed numbering, scratch tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yardstick.session import drop_stored, stored as store  # noqa: F401  scratch tables, for the operators


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partitions: the one size knob that the operators scale with."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def salted_join(many: DataFrame, one: DataFrame, keys: list[str], spread: list[str], salts: int = 16,
                how: str = "inner") -> DataFrame:
    """Join `many` with `one` (at most one row per key) so that a hot key meets in `salts` tasks, not in one.

    `spread` names columns of `many` that tell its rows of one key apart. Null keys never match.
    """
    left = many.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    right = one.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "__salt"], how).drop("__salt")


HEAVY = 256  # a key with 1 / HEAVY of all rows is heavy: there are at most HEAVY of them


def spread_join(many: DataFrame, one: DataFrame, keys: list[str], n: str, spread: list[str], salts: int = 16) -> DataFrame:
    """`many` joined with the stored table `one` (one row per key, `n` rows of `many` each): only heavy keys are salted.

    A heavy key has 1 / HEAVY of all rows or more; the list of them is broadcast, at most HEAVY rows. Its rows meet in
    `salts` tasks, told apart by the columns `spread`; `one` is copied for heavy keys alone.
    """
    total = one.agg(F.sum(n)).scalar()
    big = F.col(n) * HEAVY >= total
    heavy = F.broadcast(one.where(big).select(*keys, F.lit(True).alias("__heavy")))
    salt = F.when(F.col("__heavy"), F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")).otherwise(0)
    left = many.join(heavy, keys, "left").withColumn("__salt", salt).drop("__heavy")
    copies = F.when(big, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return left.join(one.withColumn("__salt", F.explode(copies)).drop(n), [*keys, "__salt"]).drop("__salt")


MEMBER_BITS = 1 << 22


def may_be_in(ids: DataFrame, column: str) -> Column:
    """Whether a row's `column` may be one of ids (one column of that name, distinct): a hashed bitmap of fixed size, as a scalar subquery.

    It only saves moving rows: false positives are joined, and more ids only mean more of them.
    """
    one = F.expr(f"shiftleft(1L, cast(pmod(xxhash64({column}), {MEMBER_BITS}) % 64 as int))")
    word = F.floor(F.pmod(F.xxhash64(column), F.lit(MEMBER_BITS)) / 64).cast("int")
    words = ids.groupBy(word.alias("i")).agg(F.bit_or(one).alias("w"))
    every = ids.sparkSession.range(MEMBER_BITS // 64).select(F.col("id").cast("int").alias("i"))
    laid = every.join(words, "i", "left").agg(F.sort_array(F.collect_list(F.struct("i", F.coalesce("w", F.lit(0)).alias("w")))).alias("a"))
    bitmap = laid.select(F.transform("a", lambda r: r["w"])).scalar()
    return F.coalesce(F.get(bitmap, word).bitwiseAND(one) != 0, F.lit(False))


def numbered(df: DataFrame, key: str, order: list[str], out: str, per_key: DataFrame | None = None,
             bucket: Column | None = None) -> DataFrame:
    """Number the rows of each key from 0 without gaps, in hash order, a hot key in many tasks.

    With `bucket` (long, rising with `order`, few rows each) rows are numbered by `order` itself.

    Rows fall into 4 x shuffle partitions buckets by a hash of `order`; a row's number is the
    count of its key's earlier buckets plus its place in its own bucket. `per_key` (one row per
    key) adds its columns; it joins the small bucket table, so the rows move once. `key` must
    not be null. Rows alike in `order` are numbered in any order.
    """
    k = 4 * partitions(df.sparkSession)
    rows = df.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(k)).cast("int") if bucket is None else bucket)
    by = [F.xxhash64(*order), *order] if bucket is None else order
    per = rows.groupBy(key, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(key, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    if per_key is not None:
        offsets = offsets.join(per_key, key)
    place = F.row_number().over(Window.partitionBy(key, "__b").orderBy(*by)) - 1
    return (rows.withColumn("__p", place).join(offsets, [key, "__b"])
            .withColumn(out, (F.col("__o") + F.col("__p")).cast("long")).drop("__b", "__p", "__o"))


def lower_az(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body) -> Column:
    """Evaluate `value` once per row and use it many times in `body(value)`."""
    return F.transform(F.array(value), body)[0]
