"""Raw model tables derived from the driver's tables (FIXTURES.md §2).

entity = customer ('C' + 9-digit key), metric = order priority, goal = its
leading digit, period = year. Batch side from ``orders``, stream side from
``events`` (as published messages, validated and upserted by record id),
country dimension from customer ⋈ nation ⋈ region, goal dimension from the
priorities present in ``orders``. Every table grows with its source; only the
parameters (targets, thresholds) are literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstick import schemas
from yardstick.functions import columns as C
from yardstick.operators.routing import validate
from yardstick.operators.upsert import upsert
from yardstick.params import DRIVER, DRIVER_EVENT_PRIORITY, TOPIC_PREFIX, TOPIC_VALIDATED, PanelParams


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Source-table scan (A11) with the declared schema when there is one."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = schemas.DRIVER_TABLES.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def entity_code(key) -> Column:
    return F.concat(F.lit("C"), F.lpad(C.col(key).cast("string"), 9, "0"))


def entity_name(key) -> Column:
    return F.concat(F.lit("Customer#"), F.lpad(C.col(key).cast("string"), 9, "0"))


def goal_of(metric) -> Column:
    return F.substring(C.col(metric), 1, 1).try_cast("int")


def iso_text(ts, suffix: str) -> Column:
    """Render a naive UTC timestamp as ISO text with a zone suffix."""
    return F.concat(F.date_format(C.col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(suffix))


def raw_batch(spark: SparkSession, sf_dir: str, p: PanelParams = DRIVER) -> DataFrame:
    """Batch raw table, unique on (country_code, indicator_code, year).

    value = max order price of the key; it is stored negative when the key's
    cheapest order is below the threshold, so staging's negative rule (and its
    exemption) decides whether it becomes NULL. extracted_at carries the
    malformed '+00:00Z' suffix of the reference's extractor.
    """
    o = read_table(spark, sf_dir, "orders")
    below = p.extra.get("negative_below", 20000)
    g = o.groupBy(
        F.col("o_custkey"), F.col("o_orderpriority"), F.year("o_orderdate").cast("int").alias("year")
    ).agg(
        F.max(F.col("o_totalprice").cast("decimal(18,2)")).alias("hi"),
        F.min("o_totalprice").alias("lo"),
        F.max("o_orderdate").alias("last_date"),
        # single-letter status as its code point: a numeric max keeps the
        # aggregate in HashAggregate (a string buffer would force SortAggregate)
        F.max(F.ascii("o_orderstatus")).alias("status_code"),
    ).withColumn("status", F.when(F.col("status_code").isNotNull(), F.char("status_code")))
    value = F.when(F.col("lo") < below, -F.col("hi")).otherwise(F.col("hi")).cast(C.VALUE_TYPE)
    return g.select(
        F.col("o_orderpriority").alias("indicator_code"),
        F.col("o_orderpriority").alias("indicator_name"),
        goal_of("o_orderpriority").alias("goal"),
        entity_code("o_custkey").alias("country_code"),
        entity_name("o_custkey").alias("country_name"),
        F.col("year"),
        value.alias("value"),
        F.when(F.col("status") == "O", F.lit(None).cast("string")).otherwise(F.lit("USD")).alias("unit"),
        F.col("status").alias("obs_status"),
        F.lit("orders").alias("source"),
        iso_text("last_date", "+00:00Z").alias("extracted_at"),
        F.col("last_date").alias("created_at"),
    )


def event_metric() -> Column:
    e = None
    for etype, prio in DRIVER_EVENT_PRIORITY:
        e = F.when(F.col("event_type") == etype, prio) if e is None else e.when(F.col("event_type") == etype, prio)
    return e


def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published messages (observation + record_id + published_at) from ``events``.

    Carries the arrival order (ts, event_id) and a lake object key per hour.
    """
    e = read_table(spark, sf_dir, "events")
    metric = event_metric()
    year = (F.lit(1996) + F.pmod(F.col("event_id"), F.lit(7))).cast("int")
    code = entity_code("user_id")
    landed = F.timestamp_add("SECOND", F.col("event_id"), F.col("ts"))
    hour = F.date_trunc("hour", F.col("ts"))
    prefix = dict(TOPIC_PREFIX)[TOPIC_VALIDATED]
    return e.select(
        goal_of(metric).alias("goal"),
        metric.alias("indicator_code"),
        metric.alias("indicator_name"),
        code.alias("country_code"),
        entity_name("user_id").alias("country_name"),
        F.col("user_id").cast("string").alias("country_id"),
        year.alias("year"),
        (F.col("value").cast("decimal(18,2)") * F.lit(1000)).cast(C.VALUE_TYPE).alias("value"),
        F.get_json_object("props", "$.unit").alias("unit"),
        F.get_json_object("props", "$.k").alias("obs_status"),
        F.lit("events").alias("source"),
        iso_text("ts", "Z").alias("extracted_at"),
        C.record_id(code, metric, year).alias("record_id"),
        iso_text(landed, "Z").alias("published_at"),
        F.concat(F.lit(prefix + "/"), C.date_path(hour), F.lit("/batch_"), C.stamp(hour), F.lit(".json"))
        .alias("batch_file"),
        landed.alias("created_at"),
        F.col("ts").alias("arrival_ts"),
        F.col("event_id").alias("arrival_seq"),
    )


STREAM_COLS = ("record_id", "goal", "indicator_code", "indicator_name", "country_code", "country_name",
               "year", "value", "unit", "obs_status", "source", "extracted_at", "published_at",
               "batch_file", "created_at")


def raw_stream(spark: SparkSession, sf_dir: str, p: PanelParams = DRIVER) -> DataFrame:
    """Stream raw table: valid messages upserted by record_id (H2).

    First arrival keeps every column but value and extracted_at, which come from
    the last arrival.
    """
    msgs = validate(stream_messages(spark, sf_dir), p).filter("valid")
    incoming = msgs.select(*STREAM_COLS, "arrival_ts", "arrival_seq")
    return upsert(None, incoming, ["record_id"], ["value", "extracted_at"], ["arrival_ts", "arrival_seq"])


def raw_countries(spark: SparkSession, sf_dir: str, p: PanelParams = DRIVER) -> DataFrame:
    """Country dimension raw table: customer ⋈ nation ⋈ region.

    nation and region are scans a few KB in size: the planner broadcasts them
    from file statistics, so no hint is needed."""
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    geo = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    members = set(p.members)
    j = cust.join(geo, cust["c_nationkey"] == geo["n_nationkey"], "left")
    return j.select(
        entity_code("c_custkey").alias("country_code"),
        F.col("c_name").alias("country_name"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("income_group"),
        F.col("r_name").alias("continent"),
        F.coalesce(F.col("r_name").isin(*members), F.lit(False)).alias("is_african"),
    )


def members(spark: SparkSession, sf_dir: str, p: PanelParams = DRIVER) -> DataFrame:
    """Codes of the member set (entities in the member region)."""
    return raw_countries(spark, sf_dir, p).filter("is_african").select("country_code")


def peers(spark: SparkSession, sf_dir: str, p: PanelParams = DRIVER) -> DataFrame:
    """Codes of the peer group (entities of the peer nations)."""
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").filter(F.col("n_name").isin(*p.peers))
    j = cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"], "left_semi")
    return j.select(entity_code("c_custkey").alias("country_code"))


def raw_goals(spark: SparkSession, sf_dir: str, p: PanelParams = DRIVER) -> DataFrame:
    """Goal dimension raw table from the metrics present in ``orders``."""
    pr = read_table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return pr.select(
        goal_of("o_orderpriority").alias("goal"),
        F.concat(F.lit(" "), F.substring_index("o_orderpriority", "-", -1), F.lit(" ")).alias("goal_title"),
        F.concat(F.lit("Orders of priority "), F.col("o_orderpriority")).alias("goal_description"),
        F.lit(p.horizon_year).alias("target_year"),
    )
