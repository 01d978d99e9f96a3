"""Dimensions: literal relations, member flags and set membership.

Joins are plain: a scan is broadcast by the planner from its file statistics, a
derived side by adaptive execution once its stage is measured. Only a literal
relation carries a broadcast hint, because its length is known here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from yardstick.functions.columns import is_member

BROADCAST_ROWS = 10_000


def literal_dimension(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A relation from parameter rows (A14/A15): broadcast if short, joined as the planner likes otherwise."""
    df = spark.createDataFrame(list(rows), schema)
    return F.broadcast(df) if len(rows) <= BROADCAST_ROWS else df


def member_flag(df: DataFrame, code_col: str, members, out: str, salts: int = 1) -> DataFrame:
    """Add a boolean ``out``: is ``code_col`` (as is, untrimmed) in ``members``.

    ``members`` is either a list of codes (an ``isin`` test, for a fixed set)
    or a one-column DataFrame of codes that grows with the data (a left join).
    Never NULL. With ``salts`` above 1 each code has that many copies and the rows of one code are dealt to them by
    a hash of the whole row: for rows that aren't aggregated, where one code may hold a large share, and for
    streams, where adaptive execution splits nothing. Members that the planner broadcasts as they are need no
    copies, and get none (their estimate wouldn't count the copies). Copies are merged, never broadcast: once the
    distinct members are measured, adaptive execution would judge them by their size without the copies.
    """
    if not isinstance(members, DataFrame):
        return df.withColumn(out, is_member(code_col, members))
    m = members.select(F.col(members.columns[0]).alias("__member_code")).distinct()
    m = m.withColumn("__is_member", F.lit(True))
    if salts == 1 or broadcast_by_estimate(m):
        joined = df.join(m, df[code_col] == m["__member_code"], "left")
    else:
        m = m.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
        dealt = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
        joined = dealt.join(m, (dealt[code_col] == m["__member_code"]) & (dealt["__salt"] == m["__copy"]), "left")
    return joined.withColumn(out, F.coalesce(F.col("__is_member"), F.lit(False))).drop("__member_code", "__is_member", "__copy", "__salt")


def broadcast_by_estimate(df: DataFrame) -> bool:
    """Whether the planner broadcasts df in a join: its estimated size is within the session's threshold."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit


def in_set(df: DataFrame, code_col: str, members) -> DataFrame:
    """Keep rows whose code is in ``members`` (list -> isin, DataFrame -> semi join)."""
    if not isinstance(members, DataFrame):
        return df.filter(F.col(code_col).isin(*list(members)))
    m = members.select(F.col(members.columns[0]).alias("__member_code")).distinct()
    return df.join(m, df[code_col] == m["__member_code"], "left_semi")
