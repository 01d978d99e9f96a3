"""Validation, dead-letter split and topic fan-out.

All stateless column logic: the same functions run on a batch DataFrame and on
a streaming one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardstick.functions import columns as C
from yardstick.operators.dims import member_flag
from yardstick.params import (
    REQUIRED_FIELDS,
    TOPIC_AFRICA,
    TOPIC_ALL,
    TOPIC_FAILED,
    TOPIC_VALIDATED,
    TOPIC_WORLD_BANK,
    PanelParams,
)

MESSAGE_FIELDS = (
    "goal", "indicator_code", "indicator_name", "country_code", "country_name", "country_id",
    "year", "value", "unit", "obs_status", "source", "extracted_at", "record_id", "published_at",
)

OUT_OF_RANGE = "Value out of range"
SALTS = 64


def _num_text(c: Column) -> Column:
    return c.cast("double").cast("string")


def failure_reason(p: PanelParams) -> Column:
    """First failing rule in fixed order, or NULL when the record is valid.

    Order: required fields in list order, goal range, year range, negative value
    unless exempt metric, code length, and last a value that the engine's decimal can't hold.
    """
    rules = [F.when(F.col(f).isNull(), F.lit(f"Missing required field: {f}")) for f in REQUIRED_FIELDS]
    goal, year, value = F.col("goal"), F.col("year"), F.col("value")
    code, metric = F.col("country_code"), F.col("indicator_code")
    rules += [
        F.when(~goal.between(p.min_goal, p.max_goal), F.concat(F.lit("Invalid goal number: "), goal.cast("string"))),
        F.when(~year.between(p.min_year, p.max_year), F.concat(F.lit("Invalid year: "), year.cast("string"))),
        F.when((value < 0) & ~metric.isin(*p.exempt_metrics),
               F.concat(F.lit("Unexpected negative value: "), _num_text(value))),
        F.when(F.length(code) != p.code_length, F.concat(F.lit("Invalid country code: "), code)),
        F.when(C.out_of_range(value), F.lit(OUT_OF_RANGE)),
    ]
    return F.coalesce(*rules)


def validate(df: DataFrame, p: PanelParams) -> DataFrame:
    """Add ``failure_reason`` and ``valid``."""
    return df.withColumn("failure_reason", failure_reason(p)).withColumn(
        "valid", F.col("failure_reason").isNull())


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, dead-letter) views of one validated relation."""
    return validated.filter("valid").drop("failure_reason"), validated.filter("not valid")


def out_of_range(rows: DataFrame) -> DataFrame:
    """Dead-letter rows of a load that doesn't go through validation: those whose value can't be held, with the reason.

    Staging drops them (their value is NULL there); this keeps them, with all columns.
    """
    return rows.filter(C.out_of_range("value")).withColumn("failure_reason", F.lit(OUT_OF_RANGE))


def fan_out(validated: DataFrame, members, p: PanelParams, payload_cols=MESSAGE_FIELDS,
            carry: tuple = ()) -> DataFrame:
    """One output row per (record, topic) with key = country code and a JSON value.

    Valid records go to the all, source and validated topics plus the member
    topic when the code is a member; invalid ones only to the dead-letter topic
    with ``failure_reason`` added to the payload.
    """
    flagged = member_flag(validated, "country_code", members, "__member", salts=SALTS)  # messages: a country may hold half of them
    payload = [c for c in payload_cols if c in validated.columns]
    topics = F.when(
        F.col("valid"),
        F.array_compact(F.array(
            F.lit(TOPIC_ALL), F.lit(TOPIC_WORLD_BANK),
            F.when(F.col("__member"), F.lit(TOPIC_AFRICA)), F.lit(TOPIC_VALIDATED))),
    ).otherwise(F.array(F.lit(TOPIC_FAILED)))
    # a valid message has no failure reason, and a NULL field is left out of the JSON; encoded once, before the explode
    coded = flagged.select(topics.alias("__topics"), F.col("country_code").alias("key"),
                           F.to_json(F.struct(*payload, "failure_reason")).alias("value"), "record_id", "valid", *carry)
    return coded.select(F.explode("__topics").alias("topic"), "key", "value", "record_id", "valid", *carry)


def publish_stats(routed: DataFrame) -> DataFrame:
    """Published / failed record counts and the set of topics written (D8), one row.

    One pass over the fan-out: every valid record has exactly one row on the
    validated topic and every invalid one exactly one on the dead-letter topic.
    """
    return routed.agg(
        F.count_if(F.col("valid") & (F.col("topic") == TOPIC_VALIDATED)).alias("records_published"),
        F.count_if(~F.col("valid")).alias("records_failed"),
        F.coalesce(
            F.array_join(F.array_sort(F.collect_set(F.when(F.col("valid"), F.col("topic")))), ","),
            F.lit(""),
        ).alias("topics_written"),
    )


def failures_by_reason(validated: DataFrame) -> DataFrame:
    return validated.filter("not valid").groupBy("failure_reason").agg(F.count(F.lit(1)).alias("records"))


def topic_counts(routed: DataFrame) -> DataFrame:
    """Messages per topic."""
    return routed.groupBy("topic").agg(F.count(F.lit(1)).alias("record_count"))
