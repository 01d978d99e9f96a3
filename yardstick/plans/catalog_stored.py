"""Queries over stored, bucketed and stateful tables, ranks of unbounded measures and audits of what was consumed."""

from __future__ import annotations

from pyspark.sql import functions as F

from yardstick.functions import columns as C
from yardstick.operators import combine as CB
from yardstick.operators import offsets as OF
from yardstick.operators import ranking as RK
from yardstick.operators import routing as R
from yardstick.operators.upsert import upsert_two_phase
from yardstick.params import DRIVER as _P
from yardstick.params import TOPIC_VALIDATED
from yardstick.plans import catalog as K
from yardstick.plans import oracle as O
from yardstick.plans.catalog import ORACLE, register
from yardstick.plans.models import Panel
from yardstick.session import scratch_path, stored, stored_buckets
from yardstick.sources import buckets as BK
from yardstick.sources import files as FS
from yardstick.sources import panel as src
from yardstick.streaming import stream as ST

BOUND = 64 << 20  # bytes of files a micro-batch
PANEL_KEY = ["country_code", "indicator_code", "year"]


@register("upsert_buckets", ORACLE["batch_table_upsert"])
def q_upsert_buckets(spark, sf_dir):
    """The batch table kept in buckets of its key; the messages are upserted into the buckets they fall in, twice (a replay)."""
    root = scratch_path(spark, "batch-buckets")
    BK.create_buckets(K._panel(spark, sf_dir).raw_batch, root, PANEL_KEY, 16)
    incoming = K._validated(spark, sf_dir).filter("valid").select(*K._BATCH_COLS, "arrival_ts", "arrival_seq")
    for _ in range(2):
        BK.upsert_buckets(spark, root, incoming, PANEL_KEY, ["value", "extracted_at"], ["arrival_ts", "arrival_seq"])
    return BK.read_buckets(spark, root)


def _upsert_transport(spark, sf_dir):
    """Valid and failed messages as transport rows of two topics."""
    return K._arrivals(spark, sf_dir).select(
        F.when(F.col("valid"), TOPIC_VALIDATED).otherwise(R.TOPIC_FAILED).alias("topic"), F.col("country_code").alias("key"),
        F.to_json(F.struct(*R.MESSAGE_FIELDS, "failure_reason")).alias("value"), "partition", "offset", "timestamp")


@register("stream_state_upsert", K._STREAM_UPSERT_SQL)
def q_stream_state_upsert(spark, sf_dir):
    """J8 with state: three arrivals, the query stopped and started again after each; first and last arrival of a record
    are kept in RocksDB, changed records replace those of a bucketed table."""
    src_dir, ckpt, out = K._stream_dirs(spark, "state-upsert")
    rows = stored(K._in_turns(_upsert_transport(spark, sf_dir)), "transport")
    for turn in range(K.ARRIVALS):
        K._land(rows, turn, src_dir)
        decoded = ST.decode(ST.read_topics(spark, [TOPIC_VALIDATED, R.TOPIC_FAILED], {
            "format": "json", "path": f"{src_dir}/*", "maxFilesPerTrigger": K.FILES_PER_TRIGGER}))
        with ST.rocksdb_state(spark):
            q = ST.upsert_state(decoded).writeStream.outputMode("update").option("checkpointLocation", ckpt) \
                .foreachBatch(ST.bucket_sink(out, buckets=16)).trigger(availableNow=True).start()
            ST.run_once(q)
    return BK.read_buckets(spark, out)


@register("order_price_rank", f"""
SELECT o_orderkey, o_orderpriority, cents, rank() OVER (PARTITION BY o_orderpriority ORDER BY cents DESC NULLS FIRST) AS price_rank,
       CAST({O.ratio('(cents * n - total)', 'n', 1)} AS VARCHAR) AS vs_priority_average
FROM (SELECT *, count(cents) OVER g AS n, sum(cents) OVER g AS total FROM (
        SELECT o_orderkey, o_orderpriority, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents FROM orders)
      WINDOW g AS (PARTITION BY o_orderpriority))""")
def q_order_price_rank(spark, sf_dir):
    """E3, E4 for an unbounded measure: every order's rank by price within its priority, and its distance from the average."""
    o = src.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority",
                                                       (F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("long").alias("cents"))
    ranked = RK.rank_within(o, ["o_orderpriority"], "cents", out="price_rank")
    t, n = F.col("cents").cast(C.WIDE_INT), F.col("group_n")
    diff = C.round_ratio(t * n - F.col("group_total"), n, 1)
    return ranked.select("o_orderkey", "o_orderpriority", "cents", "price_rank", diff.cast("string").alias("vs_priority_average"))


def bucketed_panel(spark, sf_dir, buckets: int = 16):
    """The panel over one table of both sides in buckets of the series key: merge, change and target gaps need no exchange."""
    pn = K._panel(spark, sf_dir)
    sides = CB.enriched_sides(pn.stg_batch, pn.stg_stream, pn.stg_goals, _P)
    rows = stored_buckets(list(sides), "panel-rows", ["country_code", "indicator_code"], buckets)
    return Panel(spark, sf_dir, _P, {"combined": CB.merge_stored(rows)})


@register("combined_bucketed", ORACLE["combined"])
def q_combined_bucketed(spark, sf_dir):
    """K5 over a bucketed table that batch and stream rows are appended to: read where it lies, precedence exchanges nothing."""
    return bucketed_panel(spark, sf_dir).combined


@register("year_over_year_bucketed", ORACLE["year_over_year"])
def q_year_over_year_bucketed(spark, sf_dir):
    """K6 over the same: the change of each series in the buckets of the merge."""
    return bucketed_panel(spark, sf_dir).yoy


@register("api_normalise_variant", K._API_OBS_SQL)
def q_api_normalise_variant(spark, sf_dir):
    """A1, B24, B25 on VARIANT: landed replies parsed once each."""
    path = scratch_path(spark, "api-variant")
    pages = FS.api_reply_pages(K._api_rows(spark, sf_dir), F.floor(F.col("event_id") / 1000).cast("long"))
    pages.write.mode("overwrite").json(path)
    raw = spark.read.schema("indicator_code string, reply string").json(path)
    return FS.normalise_api_variant(raw, K._driver_dictionary(spark), K._AS_OF)


@register("raw_stream_two_phase", ORACLE["raw_stream_upsert"])
def q_raw_stream_two_phase(spark, sf_dir):
    """H2 in hash aggregates: each record's earliest and latest arrival first, then the two rows."""
    rows = K._validated(spark, sf_dir).filter("valid").select(*src.STREAM_COLS, "arrival_ts", "arrival_seq")
    return upsert_two_phase(None, rows, ["record_id"], ["value", "extracted_at"], ["arrival_ts", "arrival_seq"])


LOST, TWICE = 97, 89  # every 97th offset of the fixture never arrives, every 89th arrives again
_AUDITED = f"""
, kept AS (SELECT part, off FROM arrivals WHERE off % {LOST} <> 5 AND off // 1000 % 7 <> 3),
consumed AS (SELECT part, off FROM kept UNION ALL SELECT part, off FROM kept WHERE off % {TWICE} < 2 OR off // 500 % 11 = 4
             UNION ALL SELECT part, off FROM kept WHERE off // 500 % 11 = 4),
seen AS (SELECT part, off, count(*) AS n FROM consumed GROUP BY part, off),
steps AS (SELECT part, off, lag(off) OVER (PARTITION BY part ORDER BY off) AS before FROM seen),
again AS (SELECT part, off, n, off - row_number() OVER (PARTITION BY part ORDER BY off) AS island FROM seen WHERE n > 1)
SELECT part AS partition, 'missing' AS kind, before + 1 AS first_offset, off - 1 AS last_offset, off - before - 1 AS offsets,
       CAST(0 AS BIGINT) AS deliveries FROM steps WHERE off > before + 1
UNION ALL SELECT part, 'redelivered', min(off), max(off), count(*), CAST(sum(n) AS BIGINT) FROM again GROUP BY part, island"""


@register("offset_audit", K._arrivals_oracle(_AUDITED))
def q_offset_audit(spark, sf_dir):
    """Records consumed with lost offsets, lost flushes and replayed flushes; what is missing and what came again."""
    off = F.col("offset")
    kept = stored(K._arrivals(spark, sf_dir).select("partition", "offset").where(
        (F.pmod(off, F.lit(LOST)) != 5) & (F.pmod(F.floor(off / 1000), F.lit(7)) != 3)), "consumed")
    replayed = F.pmod(F.floor(off / 500), F.lit(11)) == 4
    consumed = kept.unionByName(kept.where((F.pmod(off, F.lit(TWICE)) < 2) | replayed)).unionByName(kept.where(replayed))
    audit = OF.offset_audit(consumed.withColumn("topic", F.lit(TOPIC_VALIDATED)), block=256)
    return audit.drop("topic")


@register("stream_flush_ledger", K._arrivals_oracle(f"""
, turns AS (SELECT *, off * {K.ARRIVALS} // (max(off) OVER (PARTITION BY part) + 1) AS turn, off // {K._LAKE_P.max_records_per_object} AS chunk
            FROM arrivals)
SELECT CAST(turn AS BIGINT) AS batch_id, topic, CAST(count(DISTINCT part * 1000000 + chunk) AS BIGINT) AS files_written, count(*) AS records_written FROM (
  SELECT turn, part, chunk, CASE WHEN valid THEN '{TOPIC_VALIDATED}' ELSE '{R.TOPIC_FAILED}' END AS topic FROM turns
  UNION ALL SELECT turn, part, chunk, '{R.TOPIC_ALL}' FROM turns WHERE valid
  UNION ALL SELECT turn, part, chunk, '{R.TOPIC_WORLD_BANK}' FROM turns WHERE valid
  UNION ALL SELECT turn, part, chunk, '{R.TOPIC_AFRICA}' FROM turns
    WHERE valid AND country_code IN (SELECT country_code FROM member_codes))
GROUP BY turn, topic"""))
def q_stream_flush_ledger(spark, sf_dir):
    """Messages stream to the lake; each flush's files and records by topic are observed while they are written, and
    kept as a row of the ledger, one a micro-batch and topic."""
    src_dir, ckpt, lake = K._stream_dirs(spark, "flush-ledger")
    ledger = f"{lake}-ledger"
    rows = stored(K._in_turns(ST.transport_rows(K._arrivals(spark, sf_dir), K.RAW_INPUT_TOPIC)), "transport")
    members = K._members_table(spark, sf_dir)
    for turn in range(K.ARRIVALS):  # one arrival a run, taken as one micro-batch
        K._land(rows, turn, src_dir)
        decoded = ST.decode(ST.read_topics(spark, [K.RAW_INPUT_TOPIC], {"format": "json", "path": f"{src_dir}/*"}))
        routed = ST.route_stream(decoded, members, _P)
        q = routed.writeStream.option("checkpointLocation", ckpt).foreachBatch(
            ST.lake_sink(lake, K._LAKE_P, clock=lambda: K._AS_OF.replace(" ", "T"), ledger=ledger)).trigger(availableNow=True).start()
        ST.run_once(q)
    return ST.read_ledger(spark, ledger).select("batch_id", "topic", "files_written", "records_written")


@register("stream_bounded_consumer", K._fan_out_oracle(f"SELECT {K._PAYLOAD} FROM routed"))
def q_stream_bounded_consumer(spark, sf_dir):
    """The continuous consumer, a micro-batch a second of at most BOUND of files, stopped and started again while
    files arrive; every topic's payload."""
    src_dir, ckpt, out = K._stream_dirs(spark, "bounded-consumer")
    rows = stored(K._in_turns(ST.transport_rows(K._arrivals(spark, sf_dir), K.RAW_INPUT_TOPIC)), "transport")
    members = K._members_table(spark, sf_dir)

    def consume():
        decoded = ST.decode(ST.read_topics(spark, [K.RAW_INPUT_TOPIC], {"format": "json", "path": f"{src_dir}/*", "maxBytesPerTrigger": BOUND}))
        routed = ST.route_stream(decoded, members, _P)
        return ST.run_stream(routed, {"format": "parquet", "path": out, "partitionBy": ["topic"]}, ckpt, interval="1 second")

    K._land(rows, 0, src_dir)
    q = consume()
    try:
        for turn in range(1, K.ARRIVALS):
            K._land(rows, turn, src_dir)  # while the query runs
            q.stop()
            q = consume()
        q.processAllAvailable()
    finally:
        q.stop()
    return K._payload(spark.read.parquet(out))
