"""Marts and published question/answer relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yardstick.functions import columns as C
from yardstick.operators.dims import in_set
from yardstick.params import PROGRESS_CLASSES, PROGRESS_FLOOR_LABEL, PanelParams


def fct_progress(combined: DataFrame) -> DataFrame:
    """K9: one row per entity × metric × period."""
    return combined.select(
        "country_code", "indicator_code", "year", "country_name", "indicator_name", "goal", "goal_title",
        "sdg_pillar", "value", "unit", "data_source", "is_african_country", "sdg_milestone", "extracted_at")


def fct_target_achievement(gaps: DataFrame) -> DataFrame:
    """K10."""
    return gaps.select(
        "country_code", "country_name", "indicator_code", "indicator_name", "goal", "goal_title",
        "sdg_pillar", "is_african_country", "latest_year", "latest_value", "baseline_value", "baseline_year",
        "target_value", "direction", "gap_to_target", "progress_since_2015", "target_status", "years_to_2030")


def _tenths(c) -> F.Column:
    return C.scaled(c, 1)


def dim_countries(countries_stg: DataFrame, scores: DataFrame) -> DataFrame:
    """Country dimension + unweighted average of goal averages."""
    s = scores.groupBy("country_code").agg(
        F.sum(_tenths("avg_goal_score")).alias("__sum"),
        F.count("avg_goal_score").alias("__n"),
        F.sum("indicators_achieved").alias("total_indicators_achieved"),
        F.sum("indicators_on_track").alias("total_indicators_on_track"),
        F.sum("indicators_off_track").alias("total_indicators_off_track"),
        F.max("data_as_of").alias("data_as_of"),
    ).select(
        F.col("country_code").alias("__s_code"),
        C.units_to_decimal(C.round_mean("__sum", "__n"), 1, 5).alias("overall_sdg_score"),
        "total_indicators_achieved", "total_indicators_on_track", "total_indicators_off_track", "data_as_of",
    )
    j = countries_stg.join(s, countries_stg["country_code"] == s["__s_code"], "left")
    return j.select(
        "country_code", "country_name", "region", "income_group", "income_tier", "continent", "is_african",
        "overall_sdg_score", "total_indicators_achieved", "total_indicators_on_track",
        "total_indicators_off_track", "data_as_of")


def dim_goals(goals_stg: DataFrame) -> DataFrame:
    """K12."""
    return goals_stg.select("goal", "goal_title", "goal_description", "sdg_pillar", "target_year")


def tracker(scores: DataFrame, countries_stg: DataFrame, p: PanelParams) -> DataFrame:
    """Scores + country context, progress class and periods remaining.

    The overall score is a window over the entity, which has at most one row per goal, so the
    scores are read once; it is NULL for an entity that the country dimension lacks.
    """
    by_entity = Window.partitionBy("country_code")
    t = _tenths("avg_goal_score")
    overall = C.units_to_decimal(C.round_mean(F.sum(t).over(by_entity), F.count(t).over(by_entity)), 1, 5)
    c = countries_stg.select(F.col("country_code").alias("__c_code"), "region", "income_group", "income_tier")
    j = scores.withColumn("__overall", overall)
    j = j.join(c, j["country_code"] == c["__c_code"], "left")
    return j.select(
        "country_code", "country_name", "goal", "goal_title", "sdg_pillar", "indicators_tracked",
        "avg_goal_score", "indicators_achieved", "indicators_on_track", "indicators_off_track", "data_as_of",
        "region", "income_group", "income_tier",
        F.when(F.col("__c_code").isNotNull(), F.col("__overall")).alias("overall_sdg_score"),
        C.progress_category(t).alias("progress_category"),
        C.years_left("data_as_of", p.horizon_year).alias("years_remaining"),
    )


def goal_summary(scores: DataFrame, ordered: bool = True) -> DataFrame:
    """Per goal; the status uses the unrounded average (exact compare).

    ``ordered`` sorts by goal at the output edge (the mart's order); consumers
    that aggregate it further take the unordered relation."""
    t = _tenths("avg_goal_score")
    group = ("goal", "goal_title", "sdg_pillar")
    # per (goal, entity) first: the distinct count needs no set of entities in any task
    per = scores.groupBy(*group, "country_code").agg(
        F.sum(t).alias("__s"), F.count(t).alias("__c"), F.min("avg_goal_score").alias("__lo"), F.max("avg_goal_score").alias("__hi"),
        F.sum("indicators_achieved").alias("__a"), F.sum("indicators_on_track").alias("__t"), F.sum("indicators_off_track").alias("__f"))
    agg = per.groupBy(*group).agg(
        F.count("country_code").alias("countries_tracked"),
        F.sum("__s").alias("__sum"),
        F.sum("__c").alias("__n"),
        F.min("__lo").alias("lowest_country_score"),
        F.max("__hi").alias("highest_country_score"),
        F.sum("__a").alias("total_achieved"),
        F.sum("__t").alias("total_on_track"),
        F.sum("__f").alias("total_off_track"),
    )
    s, n = F.col("__sum"), F.col("__n")
    status = None  # the classes of B36 on the unrounded mean
    for lo, label in PROGRESS_CLASSES:
        status = F.when(s >= n * lo * 10, label) if status is None else status.when(s >= n * lo * 10, label)
    status = status.otherwise(PROGRESS_FLOOR_LABEL)
    out = agg.select(
        "goal", "goal_title", "sdg_pillar", "countries_tracked",
        C.units_to_decimal(C.round_mean(s, n), 1, 5).alias("africa_avg_score"),
        "lowest_country_score", "highest_country_score",
        "total_achieved", "total_on_track", "total_off_track",
        status.alias("goal_status"),
    )
    if not ordered:
        return out
    return out.orderBy(F.asc_nulls_last("goal"))  # one row per goal


PEER_COLS = ("country_code", "country_name", "goal", "goal_title", "sdg_pillar", "avg_goal_score",
             "indicators_achieved", "indicators_on_track", "indicators_off_track", "income_group", "data_as_of")


def peer_rows(scores: DataFrame, dim_c: DataFrame, peers) -> DataFrame:
    """K15's input: the scores of the peer entities with their income group."""
    east = in_set(scores, "country_code", peers)
    c = dim_c.select(F.col("country_code").alias("__c_code"), "region", "income_group")
    return east.join(c, east["country_code"] == c["__c_code"], "inner").drop("__c_code")


def peer_comparison(scores: DataFrame, dim_c: DataFrame, peers, p: PanelParams) -> DataFrame:
    """K15 from the scores; see ``peer_ranks``."""
    return peer_ranks(peer_rows(scores, dim_c, peers))


def peer_ranks(east: DataFrame) -> DataFrame:
    """rank() within goal by score desc (E3) and difference from the goal average.

    A goal partition of a window would hold every peer entity of that goal in
    one task (there are ~17 goals), so neither is computed as a window over the
    rows. The rank is read from a per-goal score histogram (scores are tenths
    in [0, 100], so <= 1001 rows per goal): rank = 1 + rows with a higher
    score; the goal average is carried in the same table. It is joined back on
    (goal, score), NULL-safe: the NULL-goal group is a partition of its own.

    The peer rows feed both the histogram and the join-back: give it rows
    read from a table where what makes them should run once. For a measure without bounds see ``ranking.rank_within``.
    """
    east = east.withColumn("__t", _tenths("avg_goal_score"))
    # (goal, score) histogram: scores are tenths clamped to [0, 1000], so it has at
    # most 1001 rows per goal whatever the number of entities; windows over it are
    # per goal but tiny, and the goal's sum/count ride along for the average.
    hist = east.groupBy("goal", "__t").agg(F.count(F.lit(1)).alias("__cnt"))
    by_goal = Window.partitionBy("goal")
    higher = F.sum("__cnt").over(by_goal.orderBy(F.col("__t").desc_nulls_first())
                                 .rowsBetween(Window.unboundedPreceding, -1))
    ranks = hist.select(
        F.col("goal").alias("__h_goal"), F.col("__t").alias("__h_t"),
        (F.coalesce(higher, F.lit(0)) + 1).alias("ea_rank"),
        F.sum(F.col("__t") * F.col("__cnt")).over(by_goal).alias("__gsum"),
        F.sum("__cnt").over(by_goal).alias("__gn"),
    )
    j = east.join(ranks,
                  east["goal"].eqNullSafe(ranks["__h_goal"]) & east["__t"].eqNullSafe(ranks["__h_t"]), "left")
    diff = C.round_ratio(F.col("__t") * F.col("__gn") - F.col("__gsum"), F.col("__gn"), 1)
    return j.select(*PEER_COLS, F.col("ea_rank").cast("long").alias("ea_rank"),
                    C.units_to_decimal(diff, 1, 6).alias("vs_ea_average"))


def best_worst_goal(summary: DataFrame) -> DataFrame:
    """Goals with the highest and the lowest average (ties -> lowest goal, NULL goal last)."""
    item = F.struct("goal", "goal_title", "africa_avg_score")
    a = summary.agg(
        F.min_by(item, F.struct(-F.col("africa_avg_score"), F.col("goal").isNull(), F.col("goal"))).alias("b"),
        F.min_by(item, F.struct(F.col("africa_avg_score"), F.col("goal").isNull(), F.col("goal"))).alias("w"),
    )
    return a.select(F.inline(F.array(
        F.struct(F.lit("best").alias("position"), F.col("b.goal").alias("goal"),
                 F.col("b.goal_title").alias("goal_title"), F.col("b.africa_avg_score").alias("africa_avg_score")),
        F.struct(F.lit("worst").alias("position"), F.col("w.goal").alias("goal"),
                 F.col("w.goal_title").alias("goal_title"), F.col("w.africa_avg_score").alias("africa_avg_score")),
    ))).filter(F.col("position").isNotNull() & F.col("africa_avg_score").isNotNull())


def peer_leaders(peers_cmp: DataFrame) -> DataFrame:
    """Rank-1 entities per goal, all ties kept."""
    return peers_cmp.filter(F.col("ea_rank") == 1).select("goal", "goal_title", "country_code", "country_name",
                                                            "avg_goal_score")


def on_track_count(tracker_df: DataFrame) -> DataFrame:
    """Number of entity-goal combinations classed 'On track'."""
    return tracker_df.agg(F.count_if(F.col("progress_category") == "On track").alias("on_track_combinations"))


def series(fct: DataFrame, entity, metric) -> DataFrame:
    """One series over the periods (ordered at the output edge); entity and metric: values or columns."""
    return fct.filter((F.col("country_code") == entity) & (F.col("indicator_code") == metric)) \
        .select("year", "value", "data_source").orderBy("year")


def longest_series(fct: DataFrame) -> DataFrame:
    """K19 for the series with the most observed periods (ties: smallest entity, then metric).

    Counts per series, one ``min_by`` over them picks the winner, and a semi join with
    that one row keeps its periods, ordered at the output edge.
    """
    per = fct.groupBy("country_code", "indicator_code").agg(F.count("value").alias("__n"))
    pick = per.agg(F.min_by(F.struct("country_code", "indicator_code"),
                            F.struct(-F.col("__n"), F.col("country_code"), F.col("indicator_code"))).alias("k"))
    pick = F.broadcast(pick.select("k.country_code", "k.indicator_code"))  # one row
    return fct.join(pick, ["country_code", "indicator_code"], "left_semi").select(
        "country_code", "indicator_code", "year", "value", "data_source").orderBy("year")
