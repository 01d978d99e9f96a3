"""Registry of queries (one per inventory row that yields a relation) and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstick import schemas

from yardstick.functions import columns as C
from yardstick.operators import marts as M
from yardstick.operators import progress as PG
from yardstick.operators import quality as QC
from yardstick.operators import routing as R
from yardstick.operators.dims import literal_dimension
from yardstick.operators.ranking import numbered_by_time
from yardstick.operators.upsert import upsert
from yardstick.params import DRIVER, DRIVER_PRIORITIES, TOPIC_ALL, TOPIC_VALIDATED
from yardstick.plans import oracle as O
from yardstick.plans.models import MART_NAMES, Panel, register_views, write_marts
from yardstick.session import scratch_path, stored
from yardstick.sources import files as FS
from yardstick.sources import panel as src
from yardstick.streaming import stream as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _panel(spark, sf_dir) -> Panel:
    return Panel(spark, sf_dir, DRIVER)


# ---- models (K1-K19) ---------------------------------------------------------------

def _model(name: str, attr: str | None = None, final: str | None = None):
    attr = attr or name
    register(name, O.with_ctes(final or f"SELECT * FROM {attr}"))(
        lambda spark, sf_dir: getattr(_panel(spark, sf_dir), attr))


_model("stg_batch")
_model("stg_stream")
_model("stg_goals")
_model("stg_countries")
_model("combined")
_model("year_over_year", "yoy")
_model("target_gaps", "gaps")
_model("scored")
_model("scores")
_model("fct_progress", final=(
    "SELECT country_code, indicator_code, year, country_name, indicator_name, goal, goal_title, sdg_pillar, value, "
    "unit, data_source, is_african_country, sdg_milestone, extracted_at FROM combined"))
_model("fct_target_achievement", final="SELECT * FROM gaps")
_model("dim_countries")
_model("dim_goals", final="SELECT goal, goal_title, goal_description, sdg_pillar, target_year FROM stg_goals")
_model("tracker")
_model("goal_summary")


@register("peer_comparison", O.with_ctes("SELECT * FROM peer_comparison"))
def q_peer_comparison(spark, sf_dir):
    """The peer rows are stored once, as histogram and join-back both read them."""
    pn = _panel(spark, sf_dir)
    return M.peer_ranks(stored(M.peer_rows(pn.scores, pn.stg_countries, pn.peers), "peer-rows"))


@register("best_worst_goal", O.with_ctes("""
SELECT * FROM (SELECT 'best' AS position, goal, goal_title, africa_avg_score FROM goal_summary
               ORDER BY africa_avg_score DESC, goal ASC NULLS LAST LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'worst' AS position, goal, goal_title, africa_avg_score FROM goal_summary
               ORDER BY africa_avg_score ASC, goal ASC NULLS LAST LIMIT 1)"""))
def q_best_worst(spark, sf_dir):
    return M.best_worst_goal(M.goal_summary(_panel(spark, sf_dir).scores, ordered=False))


@register("peer_leaders", O.with_ctes(
    "SELECT goal, goal_title, country_code, country_name, avg_goal_score FROM peer_comparison WHERE ea_rank = 1"))
def q_peer_leaders(spark, sf_dir):
    return M.peer_leaders(q_peer_comparison(spark, sf_dir))


@register("on_track_count", O.with_ctes(
    "SELECT count(*) FILTER (WHERE progress_category = 'On track') AS on_track_combinations FROM tracker"))
def q_on_track(spark, sf_dir):
    return M.on_track_count(_panel(spark, sf_dir).tracker)


@register("series", O.with_ctes("""
SELECT c.country_code, c.indicator_code, c.year, c.value, c.data_source
FROM combined c
JOIN (SELECT country_code, indicator_code FROM combined WHERE value IS NOT NULL
      GROUP BY country_code, indicator_code
      ORDER BY count(*) DESC, country_code, indicator_code LIMIT 1) k
  ON c.country_code = k.country_code AND c.indicator_code = k.indicator_code"""))
def q_series(spark, sf_dir):
    """The series with the most observed periods, over the years."""
    return M.longest_series(_panel(spark, sf_dir).fct_progress)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# ---- identity, validation, routing, statistics (H1-H3, I1-I3, D7-D9) ---------------


_P = DRIVER


def _validated(spark, sf_dir):
    return R.validate(src.stream_messages(spark, sf_dir), _P)


@register("validate_messages", O.with_ctes(
    "SELECT record_id, country_code, indicator_code, year, failure_reason, valid FROM validated"))
def q_validate(spark, sf_dir):
    return _validated(spark, sf_dir).select("record_id", "country_code", "indicator_code", "year",
                                            "failure_reason", "valid")


@register("dead_letter", O.with_ctes(
    "SELECT record_id, country_code, year, value, failure_reason FROM validated WHERE NOT valid"))
def q_dead_letter(spark, sf_dir):
    _, dead = R.split_valid(_validated(spark, sf_dir))
    return dead.select("record_id", "country_code", "year", "value", "failure_reason")


_FAN_OUT_SQL = f"""
, routed AS (
  SELECT '{R.TOPIC_ALL}' AS topic, country_code AS key, record_id, valid, CAST(NULL AS VARCHAR) AS payload_reason, year, value
    FROM validated WHERE valid
  UNION ALL SELECT '{R.TOPIC_WORLD_BANK}', country_code, record_id, valid, NULL, year, value FROM validated WHERE valid
  UNION ALL SELECT '{R.TOPIC_AFRICA}', country_code, record_id, valid, NULL, year, value FROM validated
    WHERE valid AND country_code IN (SELECT country_code FROM member_codes)
  UNION ALL SELECT '{R.TOPIC_VALIDATED}', country_code, record_id, valid, NULL, year, value FROM validated WHERE valid
  UNION ALL SELECT '{R.TOPIC_FAILED}', country_code, record_id, valid, failure_reason, year, value
    FROM validated WHERE NOT valid)
"""


def _fan_out_oracle(final: str) -> str:
    base = O.with_ctes("SELECT 1")
    return base[: base.rindex("\nSELECT 1")] + _FAN_OUT_SQL + final


def _routed(spark, sf_dir):
    members = src.members(spark, sf_dir, _P)
    return R.fan_out(_validated(spark, sf_dir), members, _P)


PARTITIONS = 3  # of the fixture's topics, keyed by entity
_PART = f"coalesce(TRY_CAST(substr(country_code, 2) AS BIGINT) % {PARTITIONS}, 0)"
_ARRIVALS_SQL = f"""
, arrivals AS (
  SELECT *, CAST({_PART} AS INTEGER) AS part,
         row_number() OVER (PARTITION BY {_PART} ORDER BY arrival_ts NULLS FIRST, arrival_seq NULLS FIRST) - 1 AS off
  FROM validated)
"""


def _arrivals(spark, sf_dir):
    """Validated messages as consumed: partition by entity, offset and broker time in arrival order."""
    part = F.coalesce(F.pmod(F.substring("country_code", 2, 9).try_cast("long"), F.lit(PARTITIONS)), F.lit(0)).cast("int")
    rows = _validated(spark, sf_dir).withColumns({"partition": part, "timestamp": F.col("arrival_ts").cast("timestamp")})
    return numbered_by_time(rows, "partition", "arrival_ts", "arrival_seq", "offset")


def _members_table(spark, sf_dir):
    """The members' codes, written once: a stream meets them again in every micro-batch."""
    return stored(src.members(spark, sf_dir, _P).distinct(), "members")


def _routed_arrivals(spark, sf_dir):
    return R.fan_out(_arrivals(spark, sf_dir), src.members(spark, sf_dir, _P), _P, carry=("partition", "offset", "timestamp"))


_PAYLOAD = "topic, record_id, key AS country_code, year, CAST(value AS DOUBLE) AS value, payload_reason AS failure_reason"
PAYLOAD_COLS = ("topic", "record_id", "country_code", "year", "value", "failure_reason")


def _payload(messages):
    """The payload of each topic's messages."""
    return messages.select("topic", F.from_json("value", schemas.DEAD_LETTER).alias("m")).select("topic", "m.*").select(*PAYLOAD_COLS)


@register("fan_out", _fan_out_oracle(
    "SELECT topic, key, record_id, valid, record_id AS payload_record_id, payload_reason FROM routed"))
def q_fan_out(spark, sf_dir):
    r = _routed(spark, sf_dir)
    return r.select("topic", "key", "record_id", "valid",
                    F.get_json_object("value", "$.record_id").alias("payload_record_id"),
                    F.get_json_object("value", "$.failure_reason").alias("payload_reason"))


@register("publish_stats", _fan_out_oracle("""
SELECT count(*) FILTER (WHERE valid AND topic = '""" + R.TOPIC_VALIDATED + """') AS records_published,
       count(*) FILTER (WHERE NOT valid) AS records_failed,
       coalesce(string_agg(DISTINCT CASE WHEN valid THEN topic END, ',' ORDER BY CASE WHEN valid THEN topic END),
                '') AS topics_written
FROM routed"""))
def q_publish_stats(spark, sf_dir):
    return R.publish_stats(_routed(spark, sf_dir))


@register("failures_by_reason", O.with_ctes(
    "SELECT failure_reason, count(*) AS records FROM validated WHERE NOT valid GROUP BY failure_reason"))
def q_failures(spark, sf_dir):
    return R.failures_by_reason(_validated(spark, sf_dir))


# every tenth kind of fault, dealt over the messages by their sequence number
FAULTS = 23
_FAULTY_SQL = f"""
, faulty AS (SELECT * REPLACE (
  CASE arrival_seq % {FAULTS} WHEN 1 THEN NULL WHEN 7 THEN 99 WHEN 8 THEN 0 ELSE goal END AS goal,
  CASE WHEN arrival_seq % {FAULTS} = 2 THEN NULL ELSE indicator_code END AS indicator_code,
  CASE arrival_seq % {FAULTS} WHEN 3 THEN NULL WHEN 10 THEN 'X' ELSE country_code END AS country_code,
  CASE WHEN arrival_seq % {FAULTS} = 4 THEN NULL ELSE country_name END AS country_name,
  CASE arrival_seq % {FAULTS} WHEN 5 THEN NULL WHEN 11 THEN 1900 ELSE year END AS year,
  CASE arrival_seq % {FAULTS} WHEN 6 THEN NULL WHEN 9 THEN -1.5 WHEN 12 THEN 1e20
    WHEN 14 THEN 99999999999999983222.0 ELSE CAST(value AS DOUBLE) END AS value) FROM messages)
"""
_RANGED = f"CASE WHEN ({O.failure_reason(_P)}) IS NULL AND abs(value) >= 1e20 THEN '{R.OUT_OF_RANGE}' ELSE {O.failure_reason(_P)} END"


@register("failures_all_reasons", O.with_ctes("SELECT 1")[: O.with_ctes("SELECT 1").rindex("\nSELECT 1")] + _FAULTY_SQL + f"""
SELECT reason AS failure_reason, count(*) AS records FROM (SELECT {_RANGED} AS reason FROM faulty)
WHERE reason IS NOT NULL GROUP BY reason""")
def q_failures_all(spark, sf_dir):
    """Every rule of the validator fails on some messages; the first failing one is reported."""
    k = F.pmod("arrival_seq", F.lit(FAULTS))

    def fault(c, faults):
        out = None
        for n, v in faults.items():
            out = (F if out is None else out).when(k == n, F.lit(v))
        return out.otherwise(F.col(c))

    faults = {"goal": {1: None, 7: 99, 8: 0}, "indicator_code": {2: None}, "country_code": {3: None, 10: "X"},
              "country_name": {4: None}, "year": {5: None, 11: 1900},
              "value": {6: None, 9: -1.5, 12: 1e20, 14: 99999999999999983222.0}}
    m = src.stream_messages(spark, sf_dir).withColumn("value", F.col("value").cast("double"))
    m = m.withColumns({c: fault(c, f).cast(m.schema[c].dataType) for c, f in faults.items()})
    return R.failures_by_reason(R.validate(m, _P))


@register("topic_counts", _fan_out_oracle("SELECT topic, count(*) AS record_count FROM routed GROUP BY topic"))
def q_topic_counts(spark, sf_dir):
    return R.topic_counts(_routed(spark, sf_dir))


@register("raw_stream_upsert", O.with_ctes("SELECT * FROM raw_stream"))
def q_raw_stream(spark, sf_dir):
    return _panel(spark, sf_dir).raw_stream


LI_KEYS = ["l_orderkey", "l_linenumber"]
LI_UPDATE = ["l_quantity", "l_extendedprice"]
LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus"]
LI_SPLIT = "1996-01-01"
_li_asc = ", ".join(f"{c} ASC NULLS FIRST" for c in LI_ORDER)
_li_desc = ", ".join(f"{c} DESC NULLS LAST" for c in LI_ORDER)


@register("upsert_two_loads", f"""
WITH li AS (SELECT *, CASE WHEN l_shipdate < TIMESTAMP '{LI_SPLIT}' THEN 0 ELSE 1 END AS epoch FROM lineitem),
f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY epoch, {_li_asc}) AS rn FROM li),
l AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY epoch DESC, {_li_desc}) AS rn FROM li)
SELECT f.l_orderkey, f.l_partkey, f.l_suppkey, f.l_linenumber, l.l_quantity, l.l_extendedprice, f.l_discount,
       f.l_tax, f.l_returnflag, f.l_linestatus, f.l_shipdate
FROM f JOIN l ON f.l_orderkey = l.l_orderkey AND f.l_linenumber = l.l_linenumber AND l.rn = 1
WHERE f.rn = 1""")
def q_upsert_two_loads(spark, sf_dir):
    """H1: a first load, then a second load upserted into it (partial-column update)."""
    li = src.read_table(spark, sf_dir, "lineitem")
    early = F.coalesce(F.col("l_shipdate") < F.lit(LI_SPLIT).cast("timestamp_ntz"), F.lit(False))  # no date: second load
    load1 = li.filter(early).withColumns({f"__ord_{c}": F.col(c) for c in LI_ORDER})
    load2 = li.filter(~early).withColumns({f"__ord_{c}": F.col(c) for c in LI_ORDER})
    order = [f"__ord_{c}" for c in LI_ORDER]
    current = upsert(None, load1, LI_KEYS, LI_UPDATE, order)
    return upsert(current, load2, LI_KEYS, LI_UPDATE, order)


@register("record_ids", O.with_ctes(
    "SELECT DISTINCT record_id, country_code, indicator_code, year FROM messages"))
def q_record_ids(spark, sf_dir):
    """H3: deterministic id per (entity, metric, period)."""
    m = src.stream_messages(spark, sf_dir)
    return m.select(C.record_id("country_code", "indicator_code", "year").alias("record_id"),
                    "country_code", "indicator_code", "year").distinct()


@register("extraction_by_goal", O.with_ctes(
    "SELECT goal, count(*) AS records FROM raw_batch WHERE value IS NOT NULL GROUP BY goal"))
def q_extraction_by_goal(spark, sf_dir):
    """Records extracted per goal."""
    return _panel(spark, sf_dir).raw_batch.filter(F.col("value").isNotNull()) \
        .groupBy("goal").agg(F.count(F.lit(1)).alias("records"))


DICTIONARY = (*DRIVER_PRIORITIES, "6-RESERVED")  # the last is in no table
_DICT_SQL = ", ".join(f"('{c}', {int(c[0])})" for c in DICTIONARY)


@register("indicators_without_data", O.with_ctes(
    f"SELECT d.indicator_code, d.goal FROM (VALUES {_DICT_SQL}) AS d(indicator_code, goal) "
    "WHERE NOT EXISTS (SELECT 1 FROM raw_batch b WHERE b.indicator_code = d.indicator_code "
    "AND b.value IS NOT NULL)"))
def q_indicators_without_data(spark, sf_dir):
    """Dictionary entries with no observation (dictionary ▷ observations)."""
    d = literal_dimension(spark, [(c, int(c[0])) for c in DICTIONARY], "indicator_code string, goal int")
    seen = _panel(spark, sf_dir).raw_batch.filter(F.col("value").isNotNull()).select("indicator_code").distinct()
    return d.join(seen, "indicator_code", "left_anti")


@register("extraction_summary", O.with_ctes(f"""
SELECT 'total' AS section, CAST(NULL AS VARCHAR) AS item, count(*) AS records FROM raw_batch WHERE value IS NOT NULL
UNION ALL SELECT 'goal', CAST(goal AS VARCHAR), count(*) FROM raw_batch WHERE value IS NOT NULL GROUP BY goal
UNION ALL SELECT 'no data', d.indicator_code, 0 FROM (VALUES {_DICT_SQL}) AS d(indicator_code, goal)
WHERE NOT EXISTS (SELECT 1 FROM raw_batch b WHERE b.indicator_code = d.indicator_code AND b.value IS NOT NULL)"""))
def q_extraction_summary(spark, sf_dir):
    """Total, records per goal and the dictionary entries without data, from one count per indicator."""
    rows = _panel(spark, sf_dir).raw_batch.filter(F.col("value").isNotNull())
    per = rows.groupBy("goal", "indicator_code").agg(F.count(F.lit(1)).alias("n"))
    d = literal_dimension(spark, [(c,) for c in DICTIONARY], "indicator_code string")
    total = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("records")).select(F.lit("total").alias("section"), F.lit(None).cast("string").alias("item"), "records")
    goals = per.groupBy("goal").agg(F.sum("n").alias("records")).select(F.lit("goal").alias("section"), F.col("goal").cast("string").alias("item"), "records")
    none = d.join(per, "indicator_code", "left_anti").select(F.lit("no data").alias("section"), F.col("indicator_code").alias("item"), F.lit(0).cast("long").alias("records"))
    return total.unionByName(goals).unionByName(none)


# ---- data quality (I4-I11) -----------------------------------------------------------

_AS_OF = _P.extra["as_of"]


@register("gate_report", O.with_ctes(f"""
SELECT 'min_rows' AS check_name, count(*) AS observed, count(*) >= {_P.gate_min_rows} AS passed FROM raw_batch
UNION ALL SELECT 'no_null_codes', count(*) FILTER (WHERE country_code IS NULL OR country_code = ''),
                 count(*) FILTER (WHERE country_code IS NULL OR country_code = '') = 0 FROM raw_batch
UNION ALL SELECT 'year_range', count(*) FILTER (WHERE year < {_P.min_year} OR year > {_P.max_year}),
                 count(*) FILTER (WHERE year < {_P.min_year} OR year > {_P.max_year}) = 0 FROM raw_batch
UNION ALL SELECT 'no_unexpected_negatives',
                 count(*) FILTER (WHERE value < 0 AND indicator_code NOT IN {O.in_list(_P.exempt_metrics)}),
                 count(*) FILTER (WHERE value < 0 AND indicator_code NOT IN {O.in_list(_P.exempt_metrics)}) = 0
                 FROM raw_batch
UNION ALL SELECT 'recent_stream_rows', count(*) FILTER (WHERE r > TIMESTAMPTZ '{_AS_OF}+00' - INTERVAL {_P.gate_recent_days} DAY),
                 count(*) FILTER (WHERE r > TIMESTAMPTZ '{_AS_OF}+00' - INTERVAL {_P.gate_recent_days} DAY) > 0
                 FROM (SELECT TRY_CAST(regexp_replace(extracted_at, '([+-]\\d\\d:\\d\\d)Z$', '\\1') AS TIMESTAMPTZ) AS r
                       FROM raw_stream)"""))
def q_gate_report(spark, sf_dir):
    pn = _panel(spark, sf_dir)
    return QC.gate_report(pn.raw_batch, pn.raw_stream, _P, _AS_OF)


@register("gate_verdict", ORACLE["gate_report"].replace("\nSELECT 'min_rows'", ",\nreport AS (SELECT 'min_rows'", 1) + """)
SELECT count(*) FILTER (WHERE passed) AS checks_passed, count(*) FILTER (WHERE NOT passed) AS checks_failed,
       coalesce(string_agg(check_name, ',' ORDER BY check_name) FILTER (WHERE NOT passed), '') AS failed_checks,
       count(*) FILTER (WHERE NOT passed) > 0 AS stop
FROM report""")
def q_gate_verdict(spark, sf_dir):
    """The verdict on which the lifecycle stops before the transform."""
    return QC.gate_verdict(q_gate_report(spark, sf_dir))


def _column_tests_sql() -> str:
    parts = []
    alias = {"fct_progress": "combined", "dim_goals": "stg_goals"}
    for model, nn, uq in QC.COLUMN_TESTS:
        rel = alias.get(model, model)
        for c in nn:
            parts.append(f"SELECT '{model}' AS model, '{c}' AS column_name, 'not_null' AS test, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {rel}")
        for c in uq:
            parts.append(f"SELECT '{model}', '{c}', 'unique', count(*) FROM (SELECT {c} FROM {rel} "
                         f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
    return O.with_ctes("\nUNION ALL ".join(parts))


@register("column_tests", _column_tests_sql())
def q_column_tests(spark, sf_dir):
    pn = _panel(spark, sf_dir).materialize()  # eleven models over four tables that are written once, as in plans/run.py
    models = {m: getattr(pn, m) for m, _, _ in QC.COLUMN_TESTS}
    return QC.column_tests(models)


# ---- files: landed replies, observation files, landing area, lake envelopes (A1-A4, A7, A8) ----


def _driver_dictionary(spark):
    """Indicator dictionary of the driver mapping (A15): code, goal, name."""
    return literal_dimension(spark, [(c, int(c[0]), c) for c in DRIVER_PRIORITIES],
                             "indicator_code string, goal int, indicator_name string")


def _api_rows(spark, sf_dir):
    """API-shaped rows from events; 'error' events carry no measurement (JSON null value)."""
    e = src.read_table(spark, sf_dir, "events")
    year = (F.lit(1996) + F.pmod(F.col("event_id"), F.lit(7))).cast("string")
    api_row = F.struct(
        src.entity_code("user_id").alias("countryiso3code"),
        F.struct(F.col("user_id").cast("string").alias("id"), src.entity_name("user_id").alias("value"))
        .alias("country"),
        year.alias("date"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.col("value")).alias("value"),
        F.lit(None).cast("string").alias("unit"),
        F.lit("").alias("obs_status"),
    )
    return e.select(src.event_metric().alias("indicator_code"), F.col("event_id"), api_row.alias("api_row"))


_API_OBS_SQL = O.with_ctes(f"""
SELECT CAST(substr(m, 1, 1) AS INTEGER) AS goal, m AS indicator_code, m AS indicator_name,
       {O.code('user_id')} AS country_code, {O.name('user_id')} AS country_name, CAST(user_id AS VARCHAR) AS country_id,
       CAST(1996 + event_id % 7 AS INTEGER) AS year, value, CAST(NULL AS VARCHAR) AS unit, '' AS obs_status,
       'World Bank Open Data' AS source, '{_AS_OF}' AS extracted_at
FROM (SELECT *, {O.event_metric()} AS m FROM events) WHERE event_type <> 'error'""")


@register("api_normalise", _API_OBS_SQL)
def q_api_normalise(spark, sf_dir):
    """A1: API replies (pages of <= 1000 rows) landed as text, read back and normalised."""
    path = scratch_path(spark, "api")
    rows = _api_rows(spark, sf_dir)
    pages = FS.api_reply_pages(rows, F.floor(F.col("event_id") / 1000).cast("long"))
    pages.write.mode("overwrite").json(path)
    raw = spark.read.schema("indicator_code string, reply string").json(path)
    return FS.normalise_api_pages(raw, _driver_dictionary(spark), _AS_OF)


def _observations(spark, sf_dir):
    m = src.stream_messages(spark, sf_dir)
    return m.select(*[F.col(c).cast("double").alias(c) if c == "value" else F.col(c) for c in FS.OBS_COLS])


_OBS_SQL = ", ".join(["goal", "indicator_code", "indicator_name", "country_code", "country_name", "country_id",
                      "year", "CAST(value AS DOUBLE) AS value", "unit", "obs_status", "source", "extracted_at"])


@register("observation_files", O.with_ctes(
    f"SELECT {_OBS_SQL}, replace(indicator_code, '.', '_') AS indicator_slug FROM messages"))
def q_observation_files(spark, sf_dir):
    """A2/A3: per-indicator tree + combined file written and read back (tree returned)."""
    path = scratch_path(spark, "obs")
    FS.write_observations(_observations(spark, sf_dir), path)
    return FS.read_indicator_tree(spark, path)


@register("observation_files_combined", O.with_ctes(f"SELECT {_OBS_SQL} FROM messages"))
def q_observation_files_combined(spark, sf_dir):
    path = scratch_path(spark, "obsc")
    FS.write_observations(_observations(spark, sf_dir), path)
    return FS.read_observations(spark, f"{path}/combined")


LANDING_DAYS = ("2024-01-30 23:00:00", "2024-01-31 06:00:00")


@register("landing_day", O.with_ctes(f"SELECT {_OBS_SQL}, '2024' AS y, '01' AS m, '31' AS d FROM messages"))
def q_landing_day(spark, sf_dir):
    """A4: two landings on different days; one day read back with partition pruning."""
    base = scratch_path(spark, "landing")
    obs = _observations(spark, sf_dir)
    first = F.coalesce(F.col("indicator_code") < "3", F.lit(False))
    FS.write_landing(obs, base, LANDING_DAYS[0])
    FS.write_landing(obs.filter(first), base, LANDING_DAYS[1])  # two landings on the second day: both stay
    FS.write_landing(obs.filter(~first), base, LANDING_DAYS[1])
    FS.write_landing(obs.filter(first), base, LANDING_DAYS[1])  # landed again: replaced
    return FS.read_landing(spark, base, "2024/01/31")


@register("lake_validated_records", O.with_ctes(
    "SELECT record_id, country_code, indicator_code, year, CAST(value AS DOUBLE) AS value, published_at, "
    f"'{TOPIC_VALIDATED}' AS topic FROM validated WHERE valid"))
def q_lake_validated(spark, sf_dir):
    """A7 then A8: envelopes per topic written to the lake, validated prefix read back and exploded."""
    path = scratch_path(spark, "lake")
    FS.write_batches(_routed_arrivals(spark, sf_dir), path, _AS_OF, _P)
    got = FS.read_batches(spark, path, TOPIC_VALIDATED)
    return got.select("record_id", "country_code", "indicator_code", "year", "value", "published_at", "topic")


_LAKE_P = _P.with_(max_records_per_object=500)  # small objects: several chunks even in small tables


@register("lake_topic_records", _fan_out_oracle(f"SELECT {_PAYLOAD} FROM routed"))
def q_lake_topics(spark, sf_dir):
    """Every topic's payload as read back from the envelopes."""
    path = scratch_path(spark, "lake")
    FS.write_batches(_routed_arrivals(spark, sf_dir), path, _AS_OF, _LAKE_P)
    return FS.read_batches(spark, path).select(*PAYLOAD_COLS)


def _arrivals_oracle(final: str) -> str:
    base = O.with_ctes("SELECT 1")
    return base[: base.rindex("\nSELECT 1")] + _ARRIVALS_SQL + final


_CHUNK = f"off // {_LAKE_P.max_records_per_object}"


@register("lake_batch_stats", _arrivals_oracle(f"""
SELECT topic, count(DISTINCT part * 1000000 + {_CHUNK}) AS files_written, count(*) AS records_written FROM (
  SELECT CASE WHEN valid THEN '{TOPIC_VALIDATED}' ELSE '{R.TOPIC_FAILED}' END AS topic, part, off FROM arrivals
  UNION ALL SELECT '{TOPIC_ALL}', part, off FROM arrivals WHERE valid
  UNION ALL SELECT '{R.TOPIC_WORLD_BANK}', part, off FROM arrivals WHERE valid
  UNION ALL SELECT '{R.TOPIC_AFRICA}', part, off FROM arrivals
    WHERE valid AND country_code IN (SELECT country_code FROM member_codes))
GROUP BY topic"""))
def q_lake_batch_stats(spark, sf_dir):
    """Files and records written per topic."""
    path = scratch_path(spark, "lake")
    FS.write_batches(_routed_arrivals(spark, sf_dir), path, _AS_OF, _LAKE_P)
    return FS.batch_stats(FS.read_batches(spark, path))


_DAY = _AS_OF[:10].replace("-", "")
_FLUSH = "CASE WHEN off * 2 < n THEN 0 ELSE 1 END"


@register("lake_stream_upsert", _arrivals_oracle(f"""
, counted AS (SELECT *, count(*) OVER (PARTITION BY part) AS n FROM arrivals),
loaded AS (SELECT *, '{dict(src.TOPIC_PREFIX)[TOPIC_VALIDATED]}/{_AS_OF[:10].replace("-", "/")}/batch_{_DAY}_'
  || printf('000000_%06d_%05d_%012d.json', {_FLUSH}, part, CAST({_CHUNK} AS BIGINT)) AS object_key
  FROM counted WHERE valid),
f AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY part, off) AS rn FROM loaded),
l AS (SELECT record_id, value, extracted_at, row_number() OVER (PARTITION BY record_id ORDER BY part DESC, off DESC) AS rn FROM loaded)
SELECT f.record_id, f.goal, f.indicator_code, f.indicator_name, f.country_code, f.country_name, f.year, l.value, f.unit,
       f.obs_status, f.source, l.extracted_at, f.published_at, f.object_key AS batch_file
FROM f JOIN l ON f.record_id = l.record_id AND l.rn = 1 WHERE f.rn = 1"""))
def q_lake_stream_upsert(spark, sf_dir):
    """A7, A8, A10, H2 end to end: messages flushed twice to the lake as envelopes of several chunks, the validated
    prefix read and upserted into the raw stream table on record_id in (object key, position) order."""
    lake = scratch_path(spark, "lake-load")
    routed = stored(_routed_arrivals(spark, sf_dir).filter(F.col("topic").isin(TOPIC_VALIDATED, R.TOPIC_FAILED)), "routed")
    sizes = routed.groupBy("partition").agg(F.count(F.lit(1)).alias("n"))  # one row a partition
    half = routed.join(F.broadcast(sizes), "partition")
    early = F.col("offset") * 2 < F.col("n")
    for batch_id, part in enumerate((half.filter(early), half.filter(~early))):
        FS.write_batches(part.drop("n"), lake, _AS_OF, _LAKE_P, batch_id=batch_id)
    return FS.load_records(FS.read_batches(spark, lake, TOPIC_VALIDATED))


# ---- streaming (J1-J9) over file streams, availableNow -----------------------------------------


RAW_INPUT_TOPIC = "sdg-raw-input"  # the producer's input as a topic, for the routing streams
FILES_PER_TRIGGER = 8  # bounds a micro-batch, whatever the input
ARRIVALS = 3  # writes of the fixture, one after the other in offset order


def _write_arrivals(df: DataFrame, path: str) -> None:
    """Land transport rows in offset order: each write holds the next stretch of every partition."""
    rows = stored(_in_turns(df), "transport")
    for i in range(ARRIVALS):
        _land(rows, i, path)


def _in_turns(df: DataFrame) -> DataFrame:
    """Transport rows with the arrival they belong to, from the first and last offset of each partition."""
    ends = df.groupBy("partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"))  # one row a partition
    turn = F.floor((F.col("offset") - F.col("lo")) * ARRIVALS / (F.col("hi") - F.col("lo") + 1))
    return df.join(F.broadcast(ends), "partition").withColumn("turn", turn.cast("int")).drop("lo", "hi")


def _land(rows: DataFrame, turn: int, path: str) -> None:
    rows.filter(F.col("turn") == turn).drop("turn").write.mode("append").json(f"{path}/arrival={turn}")


def _stream_dirs(spark, name):
    base = scratch_path(spark, name)
    return f"{base}/in", f"{base}/ckpt", f"{base}/out"


_STREAM_UPSERT_SQL = O.with_ctes("""
SELECT f.record_id, f.goal, f.indicator_code, f.indicator_name, f.country_code, f.country_name, f.year,
       l.value, f.unit, f.obs_status, f.source, l.extracted_at, f.published_at
FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY arrival_ts, arrival_seq) AS rn FROM validated WHERE valid) f
JOIN (SELECT record_id, value, extracted_at,
             row_number() OVER (PARTITION BY record_id ORDER BY arrival_ts DESC, arrival_seq DESC) AS rn
      FROM validated WHERE valid) l ON f.record_id = l.record_id AND l.rn = 1
WHERE f.rn = 1""")


@register("stream_upsert", _STREAM_UPSERT_SQL)
def q_stream_upsert(spark, sf_dir):
    """Valid and failed messages land as several arrivals over three partitions; a checkpointed
    availableNow stream subscribes to both topics, decodes, logs the validated one per micro-batch,
    and the upserted table is read over the log."""
    src_dir, ckpt, log = _stream_dirs(spark, "stream-upsert")
    topics = [TOPIC_VALIDATED, R.TOPIC_FAILED]
    routed = _arrivals(spark, sf_dir).select(
        F.when(F.col("valid"), TOPIC_VALIDATED).otherwise(R.TOPIC_FAILED).alias("topic"), F.col("country_code").alias("key"),
        F.to_json(F.struct(*R.MESSAGE_FIELDS, "failure_reason")).alias("value"), "partition", "offset", "timestamp")
    _write_arrivals(routed, src_dir)
    decoded = ST.decode(ST.read_topics(spark, topics, {"format": "json", "path": src_dir,
                                                       "maxFilesPerTrigger": FILES_PER_TRIGGER}))
    q = decoded.writeStream.option("checkpointLocation", ckpt).foreachBatch(ST.log_batches(log)) \
        .trigger(availableNow=True).start()
    ST.run_once(q)
    return ST.current_table(spark, log).drop("batch_file")


@register("stream_route", _fan_out_oracle(f"SELECT {_PAYLOAD} FROM routed"))
def q_stream_route(spark, sf_dir):
    """Raw messages streamed through validation and fan-out into a topic-partitioned
    sink (exactly-once file sink); every topic's payload read back."""
    src_dir, ckpt, out = _stream_dirs(spark, "stream-route")
    _write_arrivals(ST.transport_rows(_arrivals(spark, sf_dir), RAW_INPUT_TOPIC), src_dir)
    decoded = ST.decode(ST.read_topics(spark, [RAW_INPUT_TOPIC], {"format": "json", "path": src_dir,
                                                                  "maxFilesPerTrigger": FILES_PER_TRIGGER}))
    routed = ST.with_batch_metrics(ST.route_stream(decoded, _members_table(spark, sf_dir), _P))
    q = ST.start(routed, {"format": "parquet", "path": out, "partitionBy": ["topic"]}, ckpt)
    ST.run_once(q)
    return _payload(spark.read.parquet(out))


_BROKEN = "CASE arrival_seq % 10 WHEN 0 THEN indicator_code WHEN 1 THEN '[1,2]' END"


@register("stream_undecodable", O.with_ctes(
    f"SELECT country_code AS key, {_BROKEN} AS raw, 'Undecodable message' AS failure_reason FROM messages "
    "WHERE arrival_seq % 10 < 2"))
def q_stream_undecodable(spark, sf_dir):
    """Values that are not JSON objects reach the dead-letter topic with their raw text; none is lost."""
    src_dir, ckpt, out = _stream_dirs(spark, "stream-undecodable")
    k = F.pmod("arrival_seq", F.lit(10))
    rows = _arrivals(spark, sf_dir)
    good = ST.transport_rows(rows.filter(k >= 2), RAW_INPUT_TOPIC)
    bad = rows.filter(k < 2).select(F.lit(RAW_INPUT_TOPIC).alias("topic"), F.col("country_code").alias("key"),
                                    F.when(k == 0, F.col("indicator_code")).otherwise("[1,2]").alias("value"), "partition", "offset", "timestamp")
    _write_arrivals(good.unionByName(bad), src_dir)
    decoded = ST.decode(ST.read_topics(spark, [RAW_INPUT_TOPIC], {"format": "json", "path": src_dir,
                                                                  "maxFilesPerTrigger": FILES_PER_TRIGGER}))
    routed = ST.route_stream(decoded, _members_table(spark, sf_dir), _P)
    ST.run_once(ST.start(routed, {"format": "parquet", "path": out, "partitionBy": ["topic"]}, ckpt))
    dead = spark.read.parquet(out).filter(F.col("topic") == R.TOPIC_FAILED)
    return dead.select("key", F.get_json_object("value", "$.raw").alias("raw"),
                       F.get_json_object("value", "$.failure_reason").alias("failure_reason")).filter("raw IS NOT NULL")


# ---- materialised marts (A12, A13), latest-per definition (E5/F3), scalar families (B1-B27) ----


_MART_REL = {"fct_progress": "combined", "fct_target_achievement": "gaps", "dim_countries": "dim_countries",
             "dim_goals": "stg_goals", "tracker": "tracker", "goal_summary": "goal_summary",
             "peer_comparison": "peer_comparison"}


# mart -> four columns that tell its rows apart or carry their main measure
_MART_COLS = {
    "fct_progress": ("country_code", "indicator_code", "year", "value"),
    "fct_target_achievement": ("country_code", "indicator_code", "latest_value", "target_status"),
    "dim_countries": ("country_code", "region", "income_tier", "overall_sdg_score"),
    "dim_goals": ("goal", "goal_title", "sdg_pillar", "target_year"),
    "tracker": ("country_code", "goal", "avg_goal_score", "progress_category"),
    "goal_summary": ("goal", "countries_tracked", "africa_avg_score", "goal_status"),
    "peer_comparison": ("country_code", "goal", "ea_rank", "vs_ea_average"),
}


@register("mart_tables", O.with_ctes("\nUNION ALL ".join(
    f"SELECT '{m}' AS mart, " + ", ".join(f"CAST({c} AS VARCHAR) AS c{i}" for i, c in enumerate(cols)) + f" FROM {_MART_REL[m]}"
    for m, cols in _MART_COLS.items())))
def q_mart_tables(spark, sf_dir):
    """All seven marts rebuilt as tables from a materialised panel; every row read back."""
    base = scratch_path(spark, "marts")
    paths = write_marts(_panel(spark, sf_dir), base)
    out = None
    for name in MART_NAMES:
        part = spark.read.parquet(paths[name]).select(
            F.lit(name).alias("mart"), *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(_MART_COLS[name])])
        out = part if out is None else out.unionByName(part)
    return out


@register("staging_views", O.with_ctes("SELECT country_code, indicator_code, year, value, sdg_milestone FROM stg_batch"))
def q_staging_views(spark, sf_dir):
    """Models registered as temporary views and queried with SQL."""
    prefix = f"v{abs(hash(sf_dir)) % 10**8}_"
    register_views(_panel(spark, sf_dir), prefix)
    return spark.sql(f"SELECT country_code, indicator_code, year, value, sdg_milestone FROM {prefix}stg_batch")


@register("series_by_key", O.with_ctes("""
SELECT year, value, data_source FROM combined
WHERE (country_code, indicator_code) = (SELECT (country_code, indicator_code) FROM combined
                                        ORDER BY country_code, indicator_code LIMIT 1)"""))
def q_series_by_key(spark, sf_dir):
    """K19 as specified, one series by entity and metric: those of the smallest key."""
    fct = _panel(spark, sf_dir).fct_progress
    key = fct.agg(F.min(F.struct("country_code", "indicator_code")).alias("k"))
    return M.series(fct, key.select("k.country_code").scalar(), key.select("k.indicator_code").scalar())


@register("classifiers", f"""
SELECT l_orderkey, l_linenumber, {O.pillar('goal')} AS pillar, {O.milestone(_P)} AS milestone
FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 19 AS INTEGER) AS goal,
             CAST({_P.baseline_year} + l_suppkey % 12 AS INTEGER) AS year FROM lineitem)""")
def q_classifiers(spark, sf_dir):
    """B31, B33 over their whole range: every pillar, goals outside all, and all four milestones."""
    li = src.read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.pmod("l_partkey", F.lit(19)).cast("int").alias("goal"),
        (F.lit(_P.baseline_year) + F.pmod("l_suppkey", F.lit(12))).cast("int").alias("year"))
    return li.select("l_orderkey", "l_linenumber", C.pillar("goal").alias("pillar"), C.milestone("year", _P).alias("milestone"))


_XV, _XP = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS HUGEINT) * 10000000000000", "CAST(CAST(l_tax AS DECIMAL(18,2)) * 100 AS HUGEINT)"


@register("extreme_rates", f"""
SELECT l_orderkey, l_linenumber, CAST({O.ratio(f'({_XV} - {_XP})', _XP, 10000)} AS VARCHAR) AS pct_units,
       CAST({O.ratio(f'({_XP} - {_XV})', f'({_XV} * 3)', 10000)} AS VARCHAR) AS fall_units,
       CAST(CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE 1000 END AS BIGINT) AS score_tenths,
       CAST({_XV} * 18000 * (CASE WHEN l_linenumber % 3 = 0 THEN -1 ELSE 1 END) AS VARCHAR) AS swing_units
FROM lineitem""")
def q_extreme_rates(spark, sf_dir):
    """B5, B37, K6, K7 on outliers: values up to 1e16 against predecessors down to 0.0001 (or 0), exact in integer units;
    scores of a value far past the baseline, for the wrong or the right direction; swings between values up to
    9e19 of both signs, which no value can hold but a change can."""
    li = src.read_table(spark, sf_dir, "lineitem")
    v = (F.col("l_extendedprice").cast("decimal(18,2)") * F.lit(10 ** 11)).cast(C.VALUE_TYPE)
    p = (F.col("l_tax").cast("decimal(18,2)") / 100).cast(C.VALUE_TYPE)
    sv, sp = C.scaled(v), C.scaled(p)
    base, target = F.lit("25.0001").cast(C.VALUE_TYPE), F.lit("25").cast(C.VALUE_TYPE)
    sign = F.when(F.col("l_linenumber") % 3 == 0, -1).otherwise(1)
    big = (v.cast("decimal(38,4)") * 9000 * sign).cast(C.VALUE_TYPE)
    wrong = C.progress_score_tenths(F.lit("off track"), v, base, target, F.lit("lower"))
    right = C.progress_score_tenths(F.lit("on track"), v, F.lit("24.9999").cast(C.VALUE_TYPE), target, F.lit("higher"))
    return li.select("l_orderkey", "l_linenumber", C.round_ratio(sv - sp, sp, 10000).cast("string").alias("pct_units"),
                     C.round_ratio(sp - sv, sv * 3, 10000).cast("string").alias("fall_units"),
                     F.when(F.col("l_linenumber") % 2 == 0, wrong).otherwise(right).alias("score_tenths"),
                     C.scaled(C.change(big, -big)).cast("string").alias("swing_units"))


@register("latest_per_series", O.with_ctes(
    "SELECT country_code, indicator_code, newest.year AS year, newest.value AS value FROM ends"))
def q_latest_per(spark, sf_dir):
    """E5/F3 by definition (row_number = 1 per series, WindowGroupLimit)."""
    c = _panel(spark, sf_dir).combined.filter(F.col("value").isNotNull())
    return PG.latest_per(c).select("country_code", "indicator_code", "year", "value")


@register("scalar_text_time", O.with_ctes(f"""
SELECT event_id,
       upper(trim(' ' || lower(event_type) || ' ')) AS text_clean,
       coalesce(json_extract_string(props, '$.unit'), '') AS unit_or_empty,
       json_extract_string(props, '$.k') AS k_text,
       CAST(length(props) AS INTEGER) AS props_length,
       printf('%s:%d', event_type, event_id) AS message,
       replace(event_type || '.a.b', '.', '_') AS slug,
       md5(event_type || '_' || CAST(user_id AS VARCHAR)) AS md5_key,
       strftime(TRY_CAST(regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00Z', '([+-]\\d\\d:\\d\\d)Z$', '\\1')
                AS TIMESTAMPTZ) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS parsed,
       CAST(epoch_us(ts + to_seconds(event_id)) - epoch_us(ts) AS DOUBLE) / CAST(60000000 AS DOUBLE) AS minutes,
       ts > TIMESTAMP '{_AS_OF}' - INTERVAL 7 DAY AS recent,
       strftime(ts, '%Y/%m/%d') AS date_path,
       strftime(ts, '%Y%m%d_%H%M%S') AS stamp
FROM events"""))
def q_scalar_text_time(spark, sf_dir):
    """Text, JSON, identity and time functions (B2, B3, B6, B17-B25) over events."""
    e = src.read_table(spark, sf_dir, "events")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00Z"))
    return e.select(
        "event_id",
        C.clean_code(F.concat(F.lit(" "), F.lower("event_type"), F.lit(" "))).alias("text_clean"),
        C.default_empty(F.get_json_object("props", "$.unit")).alias("unit_or_empty"),
        F.get_json_object("props", "$.k").alias("k_text"),
        F.length("props").alias("props_length"),
        F.format_string("%s:%d", "event_type", "event_id").alias("message"),
        C.slug(F.concat("event_type", F.lit(".a.b"))).alias("slug"),
        F.md5(F.concat_ws("_", "event_type", F.col("user_id").cast("string"))).alias("md5_key"),
        F.date_format(C.parse_iso_utc(iso), "yyyy-MM-dd HH:mm:ss").alias("parsed"),
        C.minutes_between(F.timestamp_add("SECOND", F.col("event_id"), F.col("ts")), "ts").alias("minutes"),
        C.within_days("ts", 7, _AS_OF).alias("recent"),
        C.date_path("ts").alias("date_path"),
        C.stamp("ts").alias("stamp"),
    )


@register("scalar_numeric", """
SELECT l_orderkey, l_linenumber,
       CAST(l_quantity AS DECIMAL(18,2)) AS qty,
       TRY_CAST(l_returnflag AS INTEGER) AS flag_as_int,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)), 1) AS DECIMAL(18,1))
         AS discount_amount,
       abs(CAST(l_quantity AS DECIMAL(18,2)) - 25) AS qty_distance,
       nullif(l_linenumber - 1, 0) AS line_offset,
       greatest(0, least(100, CAST(l_quantity AS DECIMAL(18,2)) * 2)) AS clamped,
       l_quantity BETWEEN 10 AND 20 AS mid_quantity,
       l_returnflag IN ('A', 'R') AS flagged,
       l_shipdate IS NULL AS no_ship,
       CAST(NULL AS INTEGER) AS typed_null,
       2005 - CAST(year(l_shipdate) AS INTEGER) AS years_left
FROM lineitem""")
def q_scalar_numeric(spark, sf_dir):
    """Casts, decimal rounding, abs, nullif, clamp, ranges, IN, IS NULL, typed NULL."""
    li = src.read_table(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity").cast("decimal(18,2)")
    return li.select(
        "l_orderkey", "l_linenumber",
        qty.alias("qty"),
        F.col("l_returnflag").try_cast("int").alias("flag_as_int"),
        F.round(F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(18,2)"), 1)
        .cast("decimal(18,1)").alias("discount_amount"),
        F.abs(qty - 25).alias("qty_distance"),
        F.nullif(F.col("l_linenumber") - 1, F.lit(0)).alias("line_offset"),
        C.clamp(qty * 2, 0, 100).alias("clamped"),
        C.in_range("l_quantity", 10, 20).alias("mid_quantity"),
        F.col("l_returnflag").isin("A", "R").alias("flagged"),
        F.col("l_shipdate").isNull().alias("no_ship"),
        F.lit(None).cast("int").alias("typed_null"),
        C.years_left(F.year("l_shipdate"), 2005).alias("years_left"),
    )


@register("topic_sink", _fan_out_oracle(f"SELECT {_PAYLOAD} FROM routed"))
def q_topic_sink(spark, sf_dir):
    """A6 batch sink: messages written per topic (files partitioned by topic); every payload read back."""
    path = scratch_path(spark, "topics")
    ST.write_topics(_routed(spark, sf_dir), {"format": "json", "path": path})
    return _payload(spark.read.schema("key string, value string, topic string").json(path))


@register("lake_incremental_load", O.with_ctes(
    "SELECT record_id, country_code, year, CAST(value AS DOUBLE) AS value FROM validated WHERE valid"))
def q_lake_incremental(spark, sf_dir):
    """§1.4-19: two flushes land on different days; a checkpointed stream over the lake loads every
    unprocessed envelope of the validated topic once (restarting it loads nothing twice)."""
    base = scratch_path(spark, "lake-inc")
    lake, ckpt, out = f"{base}/lake", f"{base}/ckpt", f"{base}/loaded"
    routed = _routed_arrivals(spark, sf_dir)
    early = F.coalesce(F.col("key") < F.lit("C000000500"), F.lit(False))  # two flushes, split by key range
    FS.write_batches(routed.filter(early), lake, "2024-01-30T23:59:00", _P)
    FS.write_batches(routed.filter(~early), lake, "2024-01-31T00:01:00", _P, batch_id=1)
    rows = ST.lake_stream(spark, lake, TOPIC_VALIDATED).select("record_id", "country_code", "year", "value")
    for _ in range(2):  # second run: nothing new
        ST.run_once(rows.writeStream.option("checkpointLocation", ckpt).format("parquet").option("path", out)
                    .trigger(availableNow=True).start())
    return spark.read.parquet(out)


def _api_observations(spark, sf_dir):
    """Normalised observations of the API pages (no landing): the extractor's own output."""
    pages = FS.api_reply_pages(_api_rows(spark, sf_dir), F.floor(F.col("event_id") / 1000).cast("long"))
    return FS.normalise_api_pages(pages, _driver_dictionary(spark), _AS_OF)


_API_OBS = "(SELECT * FROM (SELECT *, " + O.event_metric() + " AS m FROM events) WHERE event_type <> 'error')"


@register("api_extraction_by_goal", O.with_ctes(
    f"SELECT CAST(substr(m, 1, 1) AS INTEGER) AS goal, count(*) AS records FROM {_API_OBS} GROUP BY 1"))
def q_api_extraction_by_goal(spark, sf_dir):
    """D7 over the extractor's output: records per goal of the normalised API pages."""
    return _api_observations(spark, sf_dir).groupBy("goal").agg(F.count(F.lit(1)).alias("records"))


@register("api_indicators_without_data", O.with_ctes(
    f"SELECT d.indicator_code, d.goal FROM (VALUES {_DICT_SQL}) AS d(indicator_code, goal) "
    f"WHERE NOT EXISTS (SELECT 1 FROM {_API_OBS} o WHERE o.m = d.indicator_code)"))
def q_api_indicators_without_data(spark, sf_dir):
    """Dictionary entries the API returned no values for (dictionary ▷ observations)."""
    d = literal_dimension(spark, [(c, int(c[0])) for c in DICTIONARY], "indicator_code string, goal int")
    seen = _api_observations(spark, sf_dir).select("indicator_code").distinct()
    return d.join(seen, "indicator_code", "left_anti")


_BATCH_COLS = ("indicator_code", "indicator_name", "goal", "country_code", "country_name", "year", "value", "unit",
               "obs_status", "source", "extracted_at", "created_at")
_BATCH_COLS_SQL = ", ".join(_BATCH_COLS)


@register("batch_table_upsert", O.with_ctes(f"""
SELECT f.indicator_code, f.indicator_name, f.goal, f.country_code, f.country_name, f.year, l.value, f.unit,
       f.obs_status, f.source, l.extracted_at, f.created_at
FROM (SELECT *, row_number() OVER (PARTITION BY country_code, indicator_code, year
                                   ORDER BY epoch, ts NULLS FIRST, seq NULLS FIRST) AS rn FROM loads) f
JOIN (SELECT country_code, indicator_code, year, value, extracted_at,
             row_number() OVER (PARTITION BY country_code, indicator_code, year
                                ORDER BY epoch DESC, ts DESC NULLS LAST, seq DESC NULLS LAST) AS rn FROM loads) l
  ON f.country_code = l.country_code AND f.indicator_code = l.indicator_code AND f.year = l.year AND l.rn = 1
WHERE f.rn = 1""").replace("\nSELECT f.indicator_code", f""",
loads AS (SELECT {_BATCH_COLS_SQL}, 0 AS epoch, CAST(NULL AS TIMESTAMP) AS ts, CAST(NULL AS BIGINT) AS seq
          FROM raw_batch
          UNION ALL
          SELECT indicator_code, indicator_name, goal, country_code, country_name, year, value, unit, obs_status,
                 source, extracted_at, created_at, 1, arrival_ts, arrival_seq FROM validated WHERE valid)
SELECT f.indicator_code""", 1))
def q_batch_table_upsert(spark, sf_dir):
    """A9/H1 on the panel key: validated messages loaded into the batch raw table keyed by
    (country, indicator, year); existing keys change only value and extracted_at."""
    current = _panel(spark, sf_dir).raw_batch
    incoming = _validated(spark, sf_dir).filter("valid").select(*_BATCH_COLS, "arrival_ts", "arrival_seq")
    return upsert(current, incoming, ["country_code", "indicator_code", "year"], ["value", "extracted_at"],
                  ["arrival_ts", "arrival_seq"])


@register("stream_lake", _fan_out_oracle(f"SELECT {_PAYLOAD} FROM routed"))
def q_stream_lake(spark, sf_dir):
    """§3.2 consumer: raw messages streamed through validation and fan-out and flushed per
    micro-batch to the lake as envelopes (idempotent per batch id); every payload read back."""
    src_dir, ckpt, lake = _stream_dirs(spark, "stream-lake")
    _write_arrivals(ST.transport_rows(_arrivals(spark, sf_dir), RAW_INPUT_TOPIC), src_dir)
    decoded = ST.decode(ST.read_topics(spark, [RAW_INPUT_TOPIC], {"format": "json", "path": src_dir,
                                                                  "maxFilesPerTrigger": FILES_PER_TRIGGER}))
    routed = ST.route_stream(decoded, _members_table(spark, sf_dir), _P)
    q = routed.writeStream.option("checkpointLocation", ckpt).foreachBatch(
        ST.lake_sink(lake, _P, clock=lambda: _AS_OF.replace(" ", "T"))).trigger(availableNow=True).start()
    ST.run_once(q)
    return FS.read_batches(spark, lake).select(*PAYLOAD_COLS)


@register("recent_extraction", _API_OBS_SQL + " AND 1996 + event_id % 7 BETWEEN 2001 AND 2002")
def q_recent_extraction(spark, sf_dir):
    """The incremental extraction: the last two calendar years of the normalised API pages."""
    return FS.recent_window(_api_observations(spark, sf_dir), 2, 2002)


@register("priority_union", O.with_ctes("SELECT * FROM unioned"))
def q_priority_union(spark, sf_dir):
    """G2/H4 alone: batch ∪ (stream ▷ batch) on (country, indicator, year), before enrichment."""
    from yardstick.operators.combine import merged_panel
    pn = _panel(spark, sf_dir)
    return merged_panel(pn.stg_batch, pn.stg_stream, _P)


@register("batch_table_versioned", ORACLE["batch_table_upsert"])
def q_batch_table_versioned(spark, sf_dir):
    """H1 "result to a new table version": the batch table written as version 1, the messages
    upserted into it as version 2, the current version read back."""
    from yardstick.sources.tables import current_version, upsert_into, write_version
    root = scratch_path(spark, "batch-table")
    write_version(_panel(spark, sf_dir).raw_batch, root, 1)
    incoming = _validated(spark, sf_dir).filter("valid").select(*_BATCH_COLS, "arrival_ts", "arrival_seq")
    upsert_into(spark, root, incoming, ["country_code", "indicator_code", "year"], ["value", "extracted_at"],
                ["arrival_ts", "arrival_seq"])
    return current_version(spark, root)[0]


from yardstick.plans import catalog_stored  # noqa: E402,F401  registers its queries on top of these
