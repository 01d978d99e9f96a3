"""File sources and sinks.

All readers take explicit schemas. Writers use Spark's own layout: JSON
lines, one directory level per partition column, so outputs split across
tasks on read. Multi-line JSON arrays (the reference's file format) are
readable (``multiline=True``), but such a file is a single split, so it is
only meant for small landed inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from yardstick import schemas
from yardstick.functions import columns as C
from yardstick.operators.upsert import upsert
from yardstick.params import (
    SOURCE_NAME,
    TOPIC_AFRICA,
    TOPIC_ALL,
    TOPIC_FAILED,
    TOPIC_PREFIX,
    TOPIC_VALIDATED,
    TOPIC_WORLD_BANK,
    UNKNOWN_TOPIC_PREFIX,
    PanelParams,
)

OBS_COLS = [f.name for f in schemas.OBSERVATION.fields]


# ---- A2/A3: observation files ---------------------------------------------------------

def read_observations(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """JSON observations with the declared schema (A2)."""
    return spark.read.schema(schemas.OBSERVATION).option("multiLine", multiline).json(path)


def write_observations(df: DataFrame, path: str) -> None:
    """Per-indicator tree (folder per slug of the code) and one combined output (A3)."""
    df.withColumn("indicator_slug", C.slug("indicator_code")).write.mode("overwrite") \
        .partitionBy("indicator_slug").json(f"{path}/by_indicator")
    df.write.mode("overwrite").json(f"{path}/combined")


def read_indicator_tree(spark: SparkSession, path: str) -> DataFrame:
    schema = schemas.extend(schemas.OBSERVATION, ("indicator_slug", StringType()))
    return spark.read.schema(schema).json(f"{path}/by_indicator")


# ---- A4: date-partitioned landing -----------------------------------------------------------

def write_landing(df: DataFrame, base: str, landed_at: str) -> None:
    """Copy to ``base/y=YYYY/m=MM/d=DD/indicator_slug=...`` for the landing day (A4).

    A day has one folder per indicator, as the landing area has one file per indicator; only
    the folders of the indicators that land are replaced (dynamic partition overwrite). So landing an
    indicator again on a day is idempotent, and other indicators and days are untouched.
    """
    ts = F.lit(landed_at).cast("timestamp")
    df.withColumns({"y": F.date_format(ts, "yyyy"), "m": F.date_format(ts, "MM"), "d": F.date_format(ts, "dd"),
                    "indicator_slug": C.slug("indicator_code")}) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("y", "m", "d", "indicator_slug").json(base)


def read_landing(spark: SparkSession, base: str, day: str | None = None) -> DataFrame:
    """Read the landing area; ``day='YYYY/MM/DD'`` prunes to one partition."""
    schema = schemas.extend(schemas.OBSERVATION, ("y", StringType()), ("m", StringType()), ("d", StringType()))
    df = spark.read.schema(schemas.extend(schema, ("indicator_slug", StringType()))).json(base).drop("indicator_slug")
    if day:
        y, m, d = day.split("/")
        df = df.filter((F.col("y") == y) & (F.col("m") == m) & (F.col("d") == d))
    return df


# ---- A1: landed API replies --------------------------------------------------------------------

def api_reply_pages(rows: DataFrame, page_key: Column, per_page: int = 1000) -> DataFrame:
    """Group API row structs into two-element replies ``[page_meta, [rows]]``.

    ``rows`` has ``indicator_code`` and ``api_row`` (struct of ``schemas.API_ROW``);
    ``page_key`` assigns each row to a page of at most ``per_page`` rows, so no
    reply (and no task holding one) grows with the data.
    """
    g = rows.groupBy("indicator_code", page_key.alias("page")).agg(
        F.count(F.lit(1)).alias("total"), F.collect_list("api_row").alias("rows"))
    meta = F.to_json(F.struct(F.col("page"), F.lit(per_page).alias("per_page"), F.col("total")))
    # explicit JSON nulls are kept (a missing field and a null field mean different things to the reader)
    body = F.to_json("rows", {"ignoreNullFields": "false"})
    return g.select("indicator_code", F.concat(F.lit("["), meta, F.lit(","), body, F.lit("]")).alias("reply"))


def _field(parsed: Column, name: str, default) -> Column:
    """``obj.get(name, default)``: the field's value when the key is present (a JSON
    null stays NULL), ``default`` when it is absent."""
    return F.when(F.map_contains_key(parsed, name), F.try_element_at(parsed, F.lit(name))).otherwise(F.lit(default))


def normalise_api_pages(raw: DataFrame, indicators: DataFrame, extracted_at: str) -> DataFrame:
    """Landed replies -> observations (A1).

    ``raw``: (indicator_code, reply text). Error replies and empty pages have no
    second element and vanish in the explode; NULL rows and rows without a value
    are dropped. The goal and name come from the indicator dictionary (a
    broadcast lookup with defaults, C8). Each row is parsed once, as a map, so that a
    missing field takes the extractor's default ('' or 0 for the date) while an
    explicit JSON null stays NULL.
    """
    rows = F.from_json(F.get_json_object("reply", "$[1]"), "array<string>")
    ex = raw.select("indicator_code", F.explode(rows).alias("r"))
    ex = ex.select("indicator_code", F.from_json("r", "map<string,string>").alias("m"))
    ex = ex.filter(F.try_element_at("m", F.lit("value")).isNotNull())
    ex = ex.withColumn("c", F.from_json(F.try_element_at("m", F.lit("country")), "map<string,string>"))
    d = indicators.select(F.col("indicator_code").alias("__d_code"), F.col("goal").alias("__d_goal"),
                          F.col("indicator_name").alias("__d_name"))
    j = ex.join(d, ex["indicator_code"] == d["__d_code"], "left")
    m, c = F.col("m"), F.col("c")
    return j.select(
        F.col("__d_goal").alias("goal"),
        F.col("indicator_code"),
        C.field_or("__d_name", "").alias("indicator_name"),
        _field(m, "countryiso3code", "").alias("country_code"),
        _field(c, "value", "").alias("country_name"),
        _field(c, "id", "").alias("country_id"),
        _field(m, "date", "0").try_cast("int").alias("year"),
        F.try_element_at(m, F.lit("value")).try_cast("double").alias("value"),
        _field(m, "unit", "").alias("unit"),
        _field(m, "obs_status", "").alias("obs_status"),
        F.lit(SOURCE_NAME).alias("source"),
        F.lit(extracted_at).alias("extracted_at"),
    )


def normalise_api_variant(raw: DataFrame, indicators: DataFrame, extracted_at: str) -> DataFrame:
    """``normalise_api_pages`` on VARIANT (A1, B24, B25): each reply is parsed once and its fields are read from the binary form.

    A field that is missing is no variant at all, a JSON null is a variant null: the first takes the extractor's default, the
    second stays NULL. A reply that is no JSON, or has no second element, gives no rows.
    """
    rows = F.try_variant_get(F.try_parse_json("reply"), "$[1]", "array<variant>")
    ex = raw.select("indicator_code", F.explode(rows).alias("r"))
    ex = ex.select("indicator_code", "r", F.try_variant_get("r", "$.value", "double").alias("value")).filter("value IS NOT NULL")

    def text(path: str, default) -> Column:
        found = F.try_variant_get("r", path, "variant")
        return F.when(found.isNull(), F.lit(default)).otherwise(F.try_variant_get("r", path, "string"))

    d = indicators.select(F.col("indicator_code").alias("__d_code"), F.col("goal").alias("__d_goal"), F.col("indicator_name").alias("__d_name"))
    j = ex.join(d, ex["indicator_code"] == d["__d_code"], "left")
    return j.select(
        F.col("__d_goal").alias("goal"), "indicator_code", C.field_or("__d_name", "").alias("indicator_name"),
        text("$.countryiso3code", "").alias("country_code"), text("$.country.value", "").alias("country_name"),
        text("$.country.id", "").alias("country_id"), text("$.date", "0").try_cast("int").alias("year"), "value",
        text("$.unit", "").alias("unit"), text("$.obs_status", "").alias("obs_status"),
        F.lit(SOURCE_NAME).alias("source"), F.lit(extracted_at).alias("extracted_at"))


def recent_window(observations: DataFrame, years: int, as_of_year: int) -> DataFrame:
    """The last ``years`` calendar years up to ``as_of_year`` (the incremental extraction)."""
    return observations.filter(F.col("year").between(as_of_year - years + 1, as_of_year))


# ---- A7/A8: micro-batch envelopes in the lake ----------------------------------------------------

def topic_prefix(topic: Column) -> Column:
    e = None
    for t, prefix in TOPIC_PREFIX:
        e = F.when(topic == t, prefix) if e is None else e.when(topic == t, prefix)
    return e.otherwise(UNKNOWN_TOPIC_PREFIX)


ENVELOPE_LINE = schemas.extend(schemas.ENVELOPE, ("lake_prefix", StringType()), ("lake_day", StringType()))


OBSERVED_TOPICS = (TOPIC_ALL, TOPIC_WORLD_BANK, TOPIC_AFRICA, TOPIC_VALIDATED, TOPIC_FAILED)


def write_batches(routed: DataFrame, path: str, written_at: str, p: PanelParams, mode: str = "append",
                  batch_id: int = 0, observe: Observation | None = None) -> None:
    """Write one envelope per topic, partition and chunk: ``{batch_metadata{...}, records[...]}``.

    ``routed`` has ``topic``, a JSON ``value`` and its consumption order, ``partition`` and
    ``offset``, and may have the broker's ``timestamp``, which the records then carry. A chunk is a run of max_records_per_object consecutive offsets of one partition, so an
    object has at most that many records, in offset order, the same on every attempt, and no
    task holds a whole topic. Stamp, batch id, partition and chunk make up the object's key: keys never
    repeat, and (key, position) orders the records of a partition as they arrived. ``observe`` counts what is written, without a
    second pass: ``files_<i>`` and ``records_<i>`` of the i-th of OBSERVED_TOPICS.
    """
    missing = {"topic", "value", "partition", "offset"} - set(routed.columns)
    if missing:
        raise ValueError(f"envelopes need the columns {sorted(missing)}")
    ts = F.lit(written_at).cast("timestamp")
    at = F.unix_micros("timestamp") if "timestamp" in routed.columns else F.lit(None).cast("long")
    # the time joins its record after the grouping: a field added to the parsed value here would parse it again for each field
    record = F.struct(F.col("offset").alias("o"), F.from_json("value", schemas.DEAD_LETTER).alias("m"), at.alias("t"))
    chunk = F.floor(F.col("offset") / F.lit(p.max_records_per_object)).cast("long")
    env = routed.groupBy("topic", "partition", chunk.alias("chunk")).agg(F.sort_array(F.collect_list(record)).alias("r"))
    prefix = topic_prefix(F.col("topic"))
    key = F.concat(prefix, F.lit("/"), C.date_path(ts), F.lit("/batch_"), C.stamp(ts),
                   F.format_string("_%06d_%05d_%012d.json", F.lit(batch_id), F.col("partition").cast("int"), "chunk"))
    out = env.select(
        F.struct(F.col("topic"), F.size("r").cast("long").alias("record_count"), F.lit(written_at).alias("written_at"),
                 key.alias("s3_key")).alias("batch_metadata"),
        F.transform("r", lambda x: x["m"].withField("broker_micros", x["t"])).alias("records"),
        prefix.alias("lake_prefix"),
        F.date_format(ts, "yyyy-MM-dd").alias("lake_day"),
    )
    if observe is not None:
        meta, counts = F.col("batch_metadata"), []
        for i, t in enumerate(OBSERVED_TOPICS):
            counts += [F.count_if(meta["topic"] == t).alias(f"files_{i}"),
                       F.coalesce(F.sum(F.when(meta["topic"] == t, meta["record_count"])), F.lit(0)).alias(f"records_{i}")]
        out = out.observe(observe, *counts)
    out.write.mode(mode).partitionBy("lake_prefix", "lake_day").json(path)


def read_batches(spark: SparkSession, path: str, topic: str | None = None, days: list[str] | None = None) -> DataFrame:
    """Lake scan of envelopes (A8): non-empty files, exploded records with provenance.

    Returns the message columns plus ``batch_file`` (logical object key),
    ``source_file`` (physical file), ``pos`` (position in the envelope) and
    ``topic``; (broker_micros, batch_file, pos) orders the records of a key as they arrived (H2): a key's
    messages share a partition, whose offsets run on from batch to batch, until the topic gains
    partitions: then the broker's time orders them.
    Prefix and day filters prune partitions.
    """
    df = spark.read.schema(ENVELOPE_LINE).json(path)
    df = df.filter(F.col("_metadata.file_size") > 0)
    if topic is not None:
        df = df.filter(F.col("lake_prefix") == dict(TOPIC_PREFIX).get(topic, UNKNOWN_TOPIC_PREFIX))
    if days:
        df = df.filter(F.col("lake_day").isin(*days))
    ex = df.select(
        F.col("batch_metadata.topic").alias("topic"),
        F.col("batch_metadata.s3_key").alias("batch_file"),
        F.col("_metadata.file_path").alias("source_file"),
        F.posexplode("records").alias("pos", "m"),
    )
    return ex.select("topic", "batch_file", "source_file", "pos", "m.*")


def batch_stats(records: DataFrame) -> DataFrame:
    """D9 over read-back envelopes: files and records written per topic."""
    return records.groupBy("topic").agg(F.count_distinct("batch_file").alias("files_written"),
                                        F.count(F.lit(1)).alias("records_written"))


LOAD_COLS = ("record_id", "goal", "indicator_code", "indicator_name", "country_code", "country_name", "year",
             "value", "unit", "obs_status", "source", "extracted_at", "published_at", "batch_file")


def load_records(records: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Lake -> raw stream table (A10): validated records upserted on record_id in (broker time, batch_file, pos) order.

    A new record keeps its first arrival's columns, batch_file among them; value and extracted_at
    come from the last arrival.
    """
    rows = records.filter(F.col("record_id").isNotNull()).select(
        *[C.to_value(c).alias(c) if c == "value" else F.col(c) for c in LOAD_COLS],
        F.col("broker_micros").alias("__at"), F.col("batch_file").alias("__file"), F.col("pos").alias("__pos"))
    return upsert(current, rows, ["record_id"], ["value", "extracted_at"], ["__at", "__file", "__pos"])
