"""Partial-column upsert (H1, H2).

``INSERT ... ON CONFLICT (keys) DO UPDATE SET value, extracted_at`` keeps the
*first* arrival of every other column and the *last* arrival of the updated
columns. Without a MERGE-capable table format this is one aggregation over
current ∪ incoming keyed by the conflict key: ``min_by`` of the kept columns
and ``max_by`` of the updated ones over a total arrival order. Both are
declarative aggregates with map-side partial aggregation, so a key that holds
a large share of the rows is combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPOCH = "__epoch"


def upsert(current: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Upsert ``incoming`` into ``current``.

    ``order_cols`` give the arrival order inside ``incoming`` (e.g. file key and
    position, or partition and offset); every row of ``current`` precedes every
    incoming row. Rows of ``current`` need not carry ``order_cols`` (they are
    already unique per key). The result has ``current``'s columns (or
    ``incoming``'s without the order columns when ``current`` is None).
    """
    keys, update_cols, order_cols = list(keys), list(update_cols), list(order_cols)
    out_cols = current.columns if current is not None else [c for c in incoming.columns if c not in order_cols]
    kept = [c for c in out_cols if c not in keys and c not in update_cols]

    inc = incoming.select(*out_cols, *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order_cols)],
                          F.lit(1).alias(EPOCH))
    if current is not None:
        cur = current.select(*out_cols, *[F.lit(None).cast(incoming.schema[c].dataType).alias(f"__o{i}")
                                          for i, c in enumerate(order_cols)], F.lit(0).alias(EPOCH))
        rows = cur.unionByName(inc)
    else:
        rows = inc
    order = F.struct(F.col(EPOCH), *[F.col(f"__o{i}") for i in range(len(order_cols))])
    aggs = []
    if kept:
        aggs.append(F.min_by(F.struct(*kept), order).alias("__first"))
    aggs.append(F.max_by(F.struct(*update_cols), order).alias("__last"))
    merged = rows.groupBy(*keys).agg(*aggs)
    return merged.select(*[
        F.col(c) if c in keys else F.col(f"__first.{c}") if c in kept else F.col(f"__last.{c}")
        for c in out_cols
    ])


PACK = 20_000_000_000_000_000_000  # of the second order column: over 2^64
EARLIEST = "-99999999999999999999999999999999999999"


def _packed(df: DataFrame, order_cols: Sequence[str]) -> Column:
    """One or two order columns as one decimal(38,0), which aggregates keep in fixed-width buffers; NULL comes first.

    Whole numbers and timestamps (as microseconds); the first must lie within 4.9e18, or the job stops.
    """
    if not 1 <= len(order_cols) <= 2:
        raise ValueError("one or two order columns can be packed")

    def whole(c: str) -> Column:
        kind, v = dict(df.dtypes)[c], F.col(c)
        if kind.startswith("timestamp"):
            v = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast(kind), v)
        return v.cast("decimal(38,0)")

    first = F.coalesce(whole(order_cols[0]), F.lit(-4_900_000_000_000_000_000).cast("decimal(38,0)"))
    if len(order_cols) == 1:
        return first
    second = F.coalesce(whole(order_cols[1]) + F.lit(str(1 << 63)).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    return (first * F.lit(str(PACK)).cast("decimal(38,0)") + second).cast("decimal(38,0)")


def upsert_two_phase(current: DataFrame | None, incoming: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
                     order_cols: Sequence[str]) -> DataFrame:
    """``upsert`` without sort-based aggregates: first each key's earliest and latest arrival, then the rows that are those.

    The arrival order is packed into one number, so the first phase is a hash aggregate over (key, number). The
    second joins on key *and* arrival, so that the rows of a hot key are dealt over all tasks and only the winners, two
    a key, meet by key. Rows that tie on the order are told apart by nothing, as in ``upsert``.
    """
    keys, update_cols, order_cols = list(keys), list(update_cols), list(order_cols)
    out_cols = current.columns if current is not None else [c for c in incoming.columns if c not in order_cols]
    kept = [c for c in out_cols if c not in keys and c not in update_cols]
    rows = incoming.select(*out_cols, _packed(incoming, order_cols).alias("__at"))
    if current is not None:
        rows = current.select(*out_cols, F.lit(EARLIEST).cast("decimal(38,0)").alias("__at")).unionByName(rows)
    ends = rows.groupBy(*keys).agg(F.min("__at").alias("__lo"), F.max("__at").alias("__hi"))
    ends = ends.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.explode(F.array_distinct(F.array("__lo", "__hi"))).alias("__end"))
    same = rows["__at"] == ends["__end"]
    for i, k in enumerate(keys):
        same = same & rows[k].eqNullSafe(ends[f"__k{i}"])
    won = rows.join(ends, same, "left_semi")
    by_key = Window.partitionBy(*keys).orderBy("__at")  # two rows a key
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    won = won.select(*keys, *[F.first(c).over(whole).alias(c) for c in kept], *[F.last(c).over(whole).alias(c) for c in update_cols],
                     F.row_number().over(by_key).alias("__rn"))
    return won.filter("__rn = 1").select(*out_cols)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (the ``unique`` test, I11)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
