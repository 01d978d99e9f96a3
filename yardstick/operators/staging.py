"""Staging models (K1-K4): cleaning and classification of the raw tables.

Each model is one ``select`` so that filters and classifiers read the *input*
columns, not the cleaned ones (a NULLed negative value survives as a row; the
member flag tests the untrimmed code).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardstick.functions import columns as C
from yardstick.operators.dims import member_flag
from yardstick.params import PanelParams


def stg_batch(raw: DataFrame, p: PanelParams, members=None) -> DataFrame:
    """K1. ``members``: list of codes (isin) or a one-column DataFrame of codes."""
    members = p.members if members is None else members
    src = raw.filter(
        F.col("country_code").isNotNull()
        & (F.col("country_code") != "")
        & F.col("year").between(p.min_year, p.max_year)
        & F.col("value").isNotNull()
    )
    flagged = member_flag(src, "country_code", members, "__member")
    return flagged.select(
        F.col("indicator_code"),
        C.clean_code("country_code").alias("country_code"),
        C.clean_text("country_name").alias("country_name"),
        F.col("goal"),
        C.clean_text("indicator_name").alias("indicator_name"),
        F.col("year").cast("int").alias("year"),
        C.clean_value("value", "indicator_code", p.exempt_metrics).alias("value"),
        C.default_empty("unit").alias("unit"),
        C.default_empty("obs_status").alias("obs_status"),
        F.col("source"),
        F.col("extracted_at"),
        F.col("created_at"),
        F.col("__member").alias("is_african_country"),
        C.milestone("year", p).alias("sdg_milestone"),
    )


def stg_stream(raw: DataFrame, p: PanelParams) -> DataFrame:
    """K2. No negative rule here; latency = first landing − latest extraction."""
    src = raw.filter(
        F.col("record_id").isNotNull()
        & F.col("country_code").isNotNull()
        & F.col("year").between(p.min_year, p.max_year)
        & F.col("value").isNotNull()
    )
    return src.select(
        F.col("record_id"),
        F.col("goal"),
        F.col("indicator_code"),
        C.clean_text("indicator_name").alias("indicator_name"),
        C.clean_code("country_code").alias("country_code"),
        C.clean_text("country_name").alias("country_name"),
        F.col("year").cast("int").alias("year"),
        C.to_value("value").alias("value"),
        C.default_empty("unit").alias("unit"),
        C.default_empty("obs_status").alias("obs_status"),
        F.col("source"),
        F.col("extracted_at"),
        F.col("published_at"),
        F.col("batch_file"),
        F.col("created_at"),
        C.minutes_between(C.as_utc_wall("created_at", raw.schema["created_at"].dataType),
                          C.parse_iso_utc("extracted_at")).alias("pipeline_latency_minutes"),
    )


def stg_goals(raw: DataFrame) -> DataFrame:
    """K3 (ordered by goal only at the output edge, see marts)."""
    return raw.select(
        F.col("goal"),
        C.clean_text("goal_title").alias("goal_title"),
        C.clean_text("goal_description").alias("goal_description"),
        F.col("target_year"),
        C.pillar("goal").alias("sdg_pillar"),
    )


def stg_countries(raw: DataFrame, p: PanelParams) -> DataFrame:
    """K4. The income tier maps the *raw* group (simple CASE on the input)."""
    return raw.select(
        F.col("country_code"),
        C.clean_text("country_name").alias("country_name"),
        C.clean_text("region").alias("region"),
        C.clean_text("income_group").alias("income_group"),
        F.col("continent"),
        F.col("is_african"),
        C.income_tier("income_group", p.income_tiers).alias("income_tier"),
    )
