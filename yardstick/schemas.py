"""Explicit schemas (never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

VALUE = DecimalType(24, 4)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


# Normalised observation record (12 fields, reference column order).
OBSERVATION = _s(
    ("goal", IntegerType()),
    ("indicator_code", StringType()),
    ("indicator_name", StringType()),
    ("country_code", StringType()),
    ("country_name", StringType()),
    ("country_id", StringType()),
    ("year", IntegerType()),
    ("value", DoubleType()),
    ("unit", StringType()),
    ("obs_status", StringType()),
    ("source", StringType()),
    ("extracted_at", StringType()),
)

# Published message = observation + record_id, published_at.
MESSAGE = StructType(OBSERVATION.fields + [
    StructField("record_id", StringType(), True),
    StructField("published_at", StringType(), True),
])

DEAD_LETTER = StructType(MESSAGE.fields + [StructField("failure_reason", StringType(), True)])

# Lake envelope written per topic per flush.
BATCH_METADATA = _s(
    ("topic", StringType()),
    ("record_count", LongType()),
    ("written_at", StringType()),
    ("s3_key", StringType()),
)
# records carry dead-letter messages' failure_reason too (NULL for valid messages), and the broker's time if there is one
ENVELOPE_RECORD = StructType(DEAD_LETTER.fields + [StructField("broker_micros", LongType(), True)])
ENVELOPE = _s(("batch_metadata", BATCH_METADATA), ("records", ArrayType(ENVELOPE_RECORD)))


def extend(schema: StructType, *fields) -> StructType:
    """A copy of ``schema`` with extra nullable (name, type) fields (StructType.add mutates)."""
    return StructType(list(schema.fields) + [StructField(n, t, True) for n, t in fields])

# API reply element: {countryiso3code, country{id,value}, date, value, unit, obs_status}.
API_ROW = _s(
    ("countryiso3code", StringType()),
    ("country", _s(("id", StringType()), ("value", StringType()))),
    ("date", StringType()),
    ("value", DoubleType()),
    ("unit", StringType()),
    ("obs_status", StringType()),
)
API_ROWS = ArrayType(API_ROW)

RAW_BATCH = _s(
    ("indicator_code", StringType()),
    ("indicator_name", StringType()),
    ("goal", IntegerType()),
    ("country_code", StringType()),
    ("country_name", StringType()),
    ("year", IntegerType()),
    ("value", VALUE),
    ("unit", StringType()),
    ("obs_status", StringType()),
    ("source", StringType()),
    ("extracted_at", StringType()),
    ("created_at", TimestampType()),
)

RAW_STREAM = _s(
    ("record_id", StringType()),
    ("goal", IntegerType()),
    ("indicator_code", StringType()),
    ("indicator_name", StringType()),
    ("country_code", StringType()),
    ("country_name", StringType()),
    ("year", IntegerType()),
    ("value", VALUE),
    ("unit", StringType()),
    ("obs_status", StringType()),
    ("source", StringType()),
    ("extracted_at", StringType()),
    ("published_at", StringType()),
    ("batch_file", StringType()),
    ("created_at", TimestampType()),
)

RAW_GOALS = _s(
    ("goal", IntegerType()),
    ("goal_title", StringType()),
    ("goal_description", StringType()),
    ("target_year", IntegerType()),
)

RAW_COUNTRIES = _s(
    ("country_code", StringType()),
    ("country_name", StringType()),
    ("region", StringType()),
    ("income_group", StringType()),
    ("continent", StringType()),
    ("is_african", BooleanType()),
)

TARGETS = _s(("indicator_code", StringType()), ("target_value", VALUE), ("direction", StringType()))

INDICATORS = _s(("indicator_code", StringType()), ("goal", IntegerType()), ("indicator_name", StringType()))


# Input tables of the driver mapping (declared, so scans skip footer schema inference).
DRIVER_TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}
