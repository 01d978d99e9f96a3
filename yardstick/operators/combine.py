"""Batch + stream merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yardstick.functions import columns as C
from yardstick.params import PanelParams

PANEL_KEYS = ("country_code", "indicator_code", "year")

COMBINED_BASE = ("indicator_code", "country_code", "country_name", "goal", "indicator_name", "year", "value",
                 "unit", "obs_status", "source", "extracted_at", "is_african_country", "sdg_milestone",
                 "data_source")


def priority_union(primary: DataFrame, secondary: DataFrame, keys: Sequence[str] = PANEL_KEYS,
                   cluster_by: Sequence[str] | None = None) -> DataFrame:
    """primary ∪ (secondary ▷ primary) on ``keys`` (G2, C1), in one shuffle.

    Both sides are unioned and a secondary row is dropped when a primary row
    has the same key. The test is a window over the key (after staging a key
    has one row per side, so partitions hold about two rows), which reads each
    side once; an anti join would read the primary side twice (rows and keys).
    As in ``NOT EXISTS`` with ``=``, keys only count: a primary row with a NULL
    value still wins, and a secondary row with a NULL key part never matches.

    ``cluster_by`` (a subset of ``keys``) hash-partitions the union by those
    columns instead; the window accepts it, and consumers keyed by the same
    columns reuse the partitioning instead of shuffling again.
    """
    keys = list(keys)
    rows = primary.withColumn("__primary", F.lit(1)).unionByName(secondary.withColumn("__primary", F.lit(0)))
    if cluster_by:
        rows = rows.repartition(*cluster_by)
    return _preferred(rows, keys)


def _preferred(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows less those without ``__primary`` whose whole key a primary row has."""
    rows = rows.withColumn("__has_primary", F.max("__primary").over(Window.partitionBy(*keys)))
    complete_key = F.lit(True)
    for k in keys:
        complete_key = complete_key & F.col(k).isNotNull()
    keep = (F.col("__primary") == 1) | ~(complete_key & (F.col("__has_primary") == 1))
    return rows.filter(keep).drop("__primary", "__has_primary")


def anti_join_union(primary: DataFrame, secondary: DataFrame, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """The literal definition (union with a left anti join), kept as the reference form for tests."""
    return primary.unionByName(secondary.join(primary.select(*keys), list(keys), "left_anti"))


def _sides(batch_stg: DataFrame, stream_stg: DataFrame, p: PanelParams) -> tuple[DataFrame, DataFrame]:
    """Both sides in the 14 columns of the merge: stream rows get a NULL goal, a member flag of true and no 'target' milestone."""
    batch = batch_stg.select(*COMBINED_BASE[:-1], F.lit("batch").alias("data_source"))
    stream = stream_stg.select(
        "indicator_code", "country_code", "country_name",
        F.lit(None).cast("int").alias("goal"),
        "indicator_name", "year", "value", "unit", "obs_status", "source", "extracted_at",
        F.lit(True).alias("is_african_country"),
        C.milestone("year", p, with_target=False).alias("sdg_milestone"),
        F.lit("streaming").alias("data_source"),
    )
    return batch, stream


def merged_panel(batch_stg: DataFrame, stream_stg: DataFrame, p: PanelParams) -> DataFrame:
    """Batch rows plus the stream rows whose key the batch lacks (14 columns).

    Per-series consumers (year over year, latest/baseline) key on (entity, metric): the merge
    is clustered by those so they need no further exchange; a series holds at most one row per
    side and year, so partitions stay bounded under skew.
    """
    return priority_union(*_sides(batch_stg, stream_stg, p), cluster_by=("country_code", "indicator_code"))


MERGED = ("indicator_code", "country_code", "country_name", "goal", "goal_title", "sdg_pillar", "indicator_name", "year", "value", "unit",
          "obs_status", "source", "extracted_at", "is_african_country", "sdg_milestone", "data_source")


def enriched_sides(batch_stg: DataFrame, stream_stg: DataFrame, goals_stg: DataFrame, p: PanelParams) -> tuple[DataFrame, DataFrame]:
    """Both sides of K5 in its 16 columns, the batch side with its goals."""
    g = goals_stg.select(F.col("goal").alias("__g_goal"), "goal_title", "sdg_pillar")
    batch, stream = _sides(batch_stg, stream_stg, p)
    batch = batch.join(g, batch["goal"] == g["__g_goal"], "left").drop("__g_goal")
    stream = stream.withColumns({c: F.lit(None).cast(goals_stg.schema[c].dataType) for c in ("goal_title", "sdg_pillar")})
    return batch.select(*MERGED), stream.select(*MERGED)


def merge_stored(rows: DataFrame) -> DataFrame:
    """K5 from one stored table that holds the rows of both sides (``enriched_sides``): batch first, by key.

    Where the table lies in buckets of the series key (``session.stored_buckets``), neither the merge nor what is
    computed by series after it exchanges anything.
    """
    return _preferred(rows.withColumn("__primary", F.when(F.col("data_source") == "batch", 1).otherwise(0)), PANEL_KEYS).select(*MERGED)


def combine(batch_stg: DataFrame, stream_stg: DataFrame, goals_stg: DataFrame, p: PanelParams) -> DataFrame:
    """K5: the merged panel enriched with the goal dimension.

    Stream rows have no goal, so the goal join can never match them: the batch side is enriched
    before the union and stream rows take typed NULLs. No NULL key enters the join, and the
    merge's partitioning by series is kept for its consumers.
    """
    batch, stream = enriched_sides(batch_stg, stream_stg, goals_stg, p)
    return priority_union(batch, stream, cluster_by=("country_code", "indicator_code"))
