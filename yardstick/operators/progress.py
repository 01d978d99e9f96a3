"""Change, distance-to-target and scores.

Scale notes. After staging the panel is unique on (entity, metric, period), and
periods are confined to [min_year, max_year], so a (entity, metric) window
partition holds at most max_year - min_year + 1 rows whatever the skew of the
entity. Latest-per-group and the baseline are one hash aggregate (partial
aggregation before the shuffle) instead of a window plus a self join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yardstick.functions import columns as C
from yardstick.params import PanelParams

SERIES = ("country_code", "indicator_code")


def year_over_year(combined: DataFrame) -> DataFrame:
    """K6: change against the previous *available* period of the same series.

    pct and annualised rates are exact hundredths (half away from zero) of
    (value - prev) / |prev| * 100 (/ years elapsed); zero predecessor -> NULL.
    Rows without a predecessor are dropped.
    """
    base = combined.filter(F.col("value").isNotNull()).select(
        "country_code", "country_name", "indicator_code", "indicator_name", "goal", "goal_title",
        "year", "value", "is_african_country")
    w = Window.partitionBy(*SERIES).orderBy("year", "value")
    lagged = base.select(
        "*",
        F.lag("value").over(w).alias("previous_year_value"),
        F.lag("year").over(w).alias("previous_year"),
    ).filter(F.col("previous_year_value").isNotNull())
    v, pv = C.scaled("value"), C.scaled("previous_year_value")
    elapsed = F.col("year") - F.col("previous_year")
    pct = C.round_ratio(v - pv, F.abs(pv), 10000)
    ann = C.round_ratio(v - pv, F.abs(pv) * elapsed, 10000)
    zero_prev = F.col("previous_year_value") == 0
    return lagged.select(
        "country_code", "country_name", "indicator_code", "indicator_name", "goal", "goal_title",
        "year", "value", "previous_year_value", "previous_year", "is_african_country",
        C.change("value", "previous_year_value").alias("absolute_change"),
        F.when(zero_prev, None).otherwise(C.units_to_decimal(pct, 2, 38)).alias("pct_change"),
        elapsed.alias("years_elapsed"),
        F.when(zero_prev | (elapsed == 0), None).otherwise(C.units_to_decimal(ann, 2, 38))
        .alias("annualised_pct_change"),
    )


LATEST_FIELDS = ("year", "value", "country_name", "indicator_name", "goal", "goal_title", "sdg_pillar",
                 "is_african_country", "data_source")


def latest_per(df: DataFrame, keys=SERIES, order: str = "year") -> DataFrame:
    """E5/F3 by definition: the newest row per group (row_number = 1).

    Ties on ``order`` are broken by the remaining latest fields, descending,
    so the result is deterministic. Catalyst plans a partial + final
    WindowGroupLimit; ``target_gaps`` uses the equivalent single aggregate.
    """
    tiebreak = [F.col(c).desc_nulls_last() for c in LATEST_FIELDS if c in df.columns and c != order]
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), *tiebreak)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def targets_frame(spark: SparkSession, p: PanelParams) -> DataFrame:
    """Inline target relation (A14), broadcast: its size is the parameter list."""
    from yardstick.sources.dimensions import targets
    return targets(spark, p)


def target_gaps(combined: DataFrame, targets: DataFrame, p: PanelParams) -> DataFrame:
    """K7: latest value, baseline, target and status per (entity, metric).

    One aggregate replaces latest-row window + baseline self join: max_by over a
    total order (year first) picks the latest row; the baseline is the value
    of the baseline period. Equal to the join form whenever the panel key is
    unique, which staging guarantees for this workload.
    """
    nn = combined.filter(F.col("value").isNotNull())
    fields = [c for c in LATEST_FIELDS]
    order = F.struct(*[F.col(c) for c in fields])
    agg = nn.groupBy(*SERIES).agg(
        F.max_by(F.struct(*fields), order).alias("l"),
        F.max(F.when(F.col("year") == p.baseline_year, F.col("value"))).alias("baseline_value"),
    )
    agg = agg.select(
        "country_code", "indicator_code",
        F.col("l.country_name").alias("country_name"),
        F.col("l.indicator_name").alias("indicator_name"),
        F.col("l.goal").alias("goal"),
        F.col("l.goal_title").alias("goal_title"),
        F.col("l.sdg_pillar").alias("sdg_pillar"),
        F.col("l.year").alias("latest_year"),
        F.col("l.value").alias("latest_value"),
        F.col("l.is_african_country").alias("is_african_country"),
        "baseline_value",
        F.when(F.col("baseline_value").isNotNull(), F.lit(p.baseline_year)).alias("baseline_year"),
    )
    t = targets.select(F.col("indicator_code").alias("__t_code"), "target_value", "direction")
    j = agg.join(t, agg["indicator_code"] == t["__t_code"], "left")
    lv, bv, tv = F.col("latest_value"), F.col("baseline_value"), F.col("target_value")
    return j.select(
        "country_code", "country_name", "indicator_code", "indicator_name", "goal", "goal_title",
        "sdg_pillar", "is_african_country", "latest_year", "latest_value", "baseline_value",
        F.col("baseline_year").cast("int").alias("baseline_year"),
        "target_value", "direction",
        C.change(lv, tv).alias("gap_to_target"),
        C.change(lv, bv).alias("progress_since_2015"),
        C.target_status(lv, bv, tv, "direction").alias("target_status"),
        C.years_left("latest_year", p.horizon_year).alias("years_to_2030"),
    )


def scored(gaps: DataFrame) -> DataFrame:
    """Member rows with a target and their progress score (tenths and decimal)."""
    g = gaps.filter((F.col("is_african_country") == F.lit(True)) & F.col("target_value").isNotNull())
    t = C.progress_score_tenths("target_status", "latest_value", "baseline_value", "target_value", "direction")
    return g.select(
        "country_code", "country_name", "indicator_code", "indicator_name", "goal", "goal_title",
        "sdg_pillar", "latest_year", "latest_value", "baseline_value", "target_value", "target_status",
        "direction", t.alias("score_tenths"),
    ).withColumn("progress_score", C.units_to_decimal("score_tenths", 1, 5))


SCORE_GROUP = ("country_code", "country_name", "goal", "goal_title", "sdg_pillar")


def scores(gaps: DataFrame) -> DataFrame:
    """K8: per member entity × goal; NULL scores removed before grouping."""
    s = scored(gaps).filter(F.col("score_tenths").isNotNull())
    agg = s.groupBy(*SCORE_GROUP).agg(
        F.count("indicator_code").alias("indicators_tracked"),
        F.sum("score_tenths").alias("__sum"),
        F.count("score_tenths").alias("__n"),
        F.count_if(F.col("target_status") == "achieved").alias("indicators_achieved"),
        F.count_if(F.col("target_status") == "on track").alias("indicators_on_track"),
        F.count_if(F.col("target_status") == "off track").alias("indicators_off_track"),
        F.max("latest_year").alias("data_as_of"),
    )
    return agg.select(
        *SCORE_GROUP, "indicators_tracked",
        C.units_to_decimal(C.round_mean("__sum", "__n"), 1, 5).alias("avg_goal_score"),
        "indicators_achieved", "indicators_on_track", "indicators_off_track", "data_as_of",
    )
