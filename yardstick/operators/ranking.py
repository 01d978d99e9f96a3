"""Ranks and running numbers without a window over a whole group.

A rank needs to know how many rows of its group come before. Nothing bounds a group here, and neither the number of
its measures: values are dealt to ranges in (group, measure) order, each range counts its rows by group, prefix sums over
the ranges give what lies before a range, and only within a range are values sorted. No task holds a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yardstick.session import stored

HEAVY = 256  # a value with 1 / HEAVY of all rows is heavy: at most HEAVY of them, whose rows are joined in SLICES tasks each
SLICES = 16


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Equal in all pairs of columns, NULL meeting NULL."""
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def rank_within(df: DataFrame, group: Sequence[str], measure: str, ranges: int | None = None, out: str = "rank") -> DataFrame:
    """``df`` plus ``out`` (SQL's rank() by ``measure`` descending within ``group``), ``group_n`` and ``group_total``
    (count and sum of the group's measures; of a decimal or whole-number measure, exact).

    Ties share a rank and the next one is skipped; NULL measures come first, as in ``ORDER BY measure DESC`` where NULL is
    the largest value; NULL groups are a group. Equal values are counted before they move, so ties never meet as rows until the
    join, which deals those of a heavy value to several tasks. The dealt values are written as a scratch table: both
    passes over them see the same ranges. ``ranges`` defaults to the session's shuffle partitions.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = list(group)
    key = [*group, measure]
    hist = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    order = [*[F.col(g).asc_nulls_first() for g in group], F.col(measure).desc_nulls_first()]
    placed = stored(hist.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()), "rank-ranges")

    wide = (F.col(measure) * F.col("__n")).cast("decimal(38,4)") if "double" not in dict(df.dtypes)[measure] else F.col(measure) * F.col("__n")
    per = placed.groupBy("__range", *group).agg(
        F.sum("__n").alias("__rows"), F.sum(wide).alias("__sum"), F.sum(F.when(F.col(measure).isNotNull(), F.col("__n"))).alias("__some"))
    whole = Window.partitionBy(*group)  # one row a range
    before = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("__range").alias("__r"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
                     F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
                     F.coalesce(F.sum("__some").over(whole), F.lit(0)).alias("group_n"), F.sum("__sum").over(whole).alias("group_total"))
    inside = Window.partitionBy("__range", *group).orderBy(F.col(measure).desc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    values = placed.withColumn("__own", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    values = values.join(per, (values["__range"] == per["__r"]) & _same(values, per, [(g, f"__g{i}") for i, g in enumerate(group)]))

    total = placed.agg(F.sum("__n")).scalar()
    heavy = placed.where(F.col("__n") * HEAVY >= total).select(*[F.col(c).alias(f"__h{i}") for i, c in enumerate(key)], F.lit(True).alias("__heavy"))
    rows = df.join(F.broadcast(heavy), _same(df, heavy, [(c, f"__h{i}") for i, c in enumerate(key)]), "left")
    salt = F.when(F.col("__heavy"), F.pmod(F.xxhash64(*df.columns), F.lit(SLICES)).cast("int")).otherwise(0)
    rows = rows.select(*df.columns, salt.alias("__salt"))
    copies = F.when(F.col("__n") * HEAVY >= total, F.sequence(F.lit(0), F.lit(SLICES - 1))).otherwise(F.array(F.lit(0)))
    ranks = values.select(*[F.col(c).alias(f"__v{i}") for i, c in enumerate(key)], (F.col("__before") + F.col("__own") + 1).alias(out),
                          "group_n", "group_total", F.explode(copies).alias("__copy"))
    cond = (rows["__salt"] == ranks["__copy"]) & _same(rows, ranks, [(c, f"__v{i}") for i, c in enumerate(key)])
    return rows.join(ranks, cond).select(*df.columns, F.col(out).cast("long").alias(out), F.col("group_n").cast("long").alias("group_n"), "group_total")


def numbered_by_time(df: DataFrame, key: str, time: str, tie: str, out: str, unit: str = "minute") -> DataFrame:
    """``df`` plus ``out``: rows of each ``key`` numbered from 0 in (``time``, ``tie``) order, however few the keys are.

    Rows are counted by (key, minute), prefix sums over a key's minutes give what comes before each, and only the
    rows of one minute are sorted together. NULL times come first. A minute that holds most rows wants a smaller ``unit``.
    """
    rows = df.withColumn("__unit", F.date_trunc(unit, F.col(time)))
    per = rows.groupBy(key, "__unit").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(key).orderBy(F.col("__unit").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col(key).alias("__k"), F.col("__unit").alias("__u"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy(key, "__unit").orderBy(F.col(time).asc_nulls_first(), F.col(tie).asc_nulls_first())) - 1
    rows = rows.withColumn("__place", place)
    joined = rows.join(per, _same(rows, per, [(key, "__k"), ("__unit", "__u")]))
    return joined.select(*df.columns, (F.col("__before") + F.col("__place")).cast("long").alias(out))
