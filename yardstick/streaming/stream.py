"""Structured Streaming operators.

The source is injectable: Kafka when the connector is on the classpath, or a
file stream of JSON lines ``{topic, key, value, partition, offset}`` (the same
columns the Kafka source yields) for tests and replays. Everything between
source and sink is the batch code unchanged: decoding, validation and fan-out
are stateless column expressions.

The upsert has two forms. In the log form each micro-batch's
valid records are appended to a log partition named by its batch id
(overwritten on retry, so a replayed batch is idempotent), and the current
table is the H2 upsert over the log. In the stateful form the first and last
arrival of every record id are kept in the RocksDB state store, and each micro-batch's changed rows replace those of a
bucketed table. Arrivals are ordered by (broker time, batch id, partition, offset): a topic that gains
partitions moves keys, and only the time orders a key's messages in two partitions.
Checkpoints make the source offsets and the sink commit atomic, so nothing is
lost when a write fails or an executor dies (the reference's consumer could
drop a buffer on a failed flush).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from yardstick import schemas
from yardstick.functions import columns as C
from yardstick.operators import routing as R
from yardstick.operators.upsert import upsert
from yardstick.params import TOPIC_PREFIX, TOPIC_VALIDATED, UNKNOWN_TOPIC_PREFIX, PanelParams
from yardstick.session import drop_stored, on_path, stored
from yardstick.sources.buckets import create_buckets, upsert_buckets

TRANSPORT = "topic string, key string, value string, partition int, offset long"
TIMED = TRANSPORT + ", timestamp timestamp"  # with the broker's time


def read_topics(spark: SparkSession, topics: Sequence[str], source: dict) -> DataFrame:
    """Subscribe to several topics as one stream with a ``topic`` column.

    ``source['format']`` is 'kafka' (options passed through, earliest offsets)
    or a file format ('json') with ``source['path']``; files are taken in
    arrival order, ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bounds a micro-batch. ``timestamp`` is the broker's
    (log append time), NULL in files that carry none.
    """
    fmt = source.get("format", "json")
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").option("subscribe", ",".join(topics)) \
            .option("startingOffsets", "earliest")
        for k, v in source.get("options", {}).items():
            reader = reader.option(k, v)
        raw = reader.load().select(
            "topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
            "partition", "offset", "timestamp")
    else:
        reader = spark.readStream.format(fmt).schema(TIMED)
        for bound in ("maxFilesPerTrigger", "maxBytesPerTrigger"):
            if bound in source:
                reader = reader.option(bound, source[bound])
        raw = reader.load(source["path"])
    return raw.filter(F.col("topic").isin(*topics))


def decode(stream: DataFrame) -> DataFrame:
    """JSON value -> message columns plus the raw ``payload`` and ``decodable``.

    Each value is parsed once, as a map; a field that is missing or of another type is NULL. A value that is not a JSON object is kept with ``decodable = false`` (to be
    routed to the dead-letter output) instead of being dropped.
    """
    at = F.col("timestamp") if "timestamp" in stream.columns else F.lit(None).cast("timestamp").alias("timestamp")
    parsed = stream.select("topic", "key", "partition", "offset", at, F.col("value").alias("payload"),
                           F.from_json("value", "map<string,string>").alias("m"))
    fields = [F.try_element_at("m", F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in schemas.DEAD_LETTER.fields]
    return parsed.select("topic", "key", "partition", "offset", "timestamp", "payload", F.col("m").isNotNull().alias("decodable"), *fields)


def undecodable(decoded: DataFrame) -> DataFrame:
    """Messages that could not be decoded, as dead-letter rows."""
    return decoded.filter(~F.col("decodable")).select(
        "topic", "key", "partition", "offset", "timestamp", "payload", F.lit("Undecodable message").alias("failure_reason"))


def route_stream(decoded: DataFrame, members, p: PanelParams) -> DataFrame:
    """Validate and fan out a decoded stream (stateless, same code as batch).

    Undecodable messages go to the dead-letter topic with their raw value.
    """
    good = R.validate(decoded.filter("decodable"), p)
    routed = R.fan_out(good, members, p, carry=("partition", "offset", "timestamp"))
    bad = undecodable(decoded).select(
        F.lit(R.TOPIC_FAILED).alias("topic"), "key",
        F.to_json(F.struct(F.col("payload").alias("raw"), "failure_reason")).alias("value"),
        F.lit(None).cast("string").alias("record_id"), F.lit(False).alias("valid"), "partition", "offset", "timestamp")
    return routed.unionByName(bad)


def with_batch_metrics(routed: DataFrame, name: str = "routing") -> DataFrame:
    """Per-micro-batch counts (D9) reported in the query progress, computed in the
    same pass as the sink write: messages, failed messages, validated messages."""
    return routed.observe(
        name,
        F.count(F.lit(1)).alias("messages"),
        F.count_if(~F.col("valid")).alias("failed"),
        F.count_if(F.col("topic") == TOPIC_VALIDATED).alias("validated"),
    )


def start(df: DataFrame, sink: dict, checkpoint: str, trigger: dict | None = None,
          name: str | None = None) -> StreamingQuery:
    """Start a checkpointed sink.

    ``sink['format']``: 'kafka' (needs ``topic``/``key``/``value`` columns) or a
    file format with ``path`` and optional ``partitionBy``. ``trigger``:
    {'processingTime': '5 minutes'} for the continuous consumer,
    {'availableNow': True} for a bounded run that drains what is there.
    """
    fmt = sink.get("format", "parquet")
    if fmt == "kafka":  # the Kafka sink takes only its transport columns
        df = df.select("topic", "key", "value")
    w = df.writeStream.option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if fmt == "kafka":
        w = w.format("kafka")
        for k, v in sink.get("options", {}).items():
            w = w.option(k, v)
    else:
        w = w.format(fmt).option("path", sink["path"])
        if sink.get("partitionBy"):
            w = w.partitionBy(*sink["partitionBy"])
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.outputMode("append").start()


def run_stream(df: DataFrame, sink: dict, checkpoint: str, interval: str = "300 seconds",
               name: str | None = None) -> StreamingQuery:
    """Continuous consumer (J2): one micro-batch per ``interval`` (the reference flushes every 300 s)."""
    return start(df, sink, checkpoint, trigger={"processingTime": interval}, name=name)


def run_once(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Bounded run (J3): wait for an availableNow query to drain; after ``timeout_s`` it is stopped."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
    if query.exception():
        raise query.exception()


def write_topics(routed: DataFrame, sink: dict) -> None:
    """Batch topic sink (A6): Kafka (topic/key/value columns) or files partitioned by topic."""
    out = routed.select("topic", "key", "value")
    if sink.get("format") == "kafka":
        w = out.write.format("kafka")
        for k, v in sink.get("options", {}).items():
            w = w.option(k, v)
        w.save()
    else:
        out.write.mode(sink.get("mode", "append")).partitionBy("topic").format(sink.get("format", "json")) \
            .save(sink["path"])


def lake_stream(spark: SparkSession, path: str, topic: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Unprocessed lake envelopes as a stream (A8 incremental, SURVEY §1.4-19).

    With a checkpoint, each envelope file is read exactly once whatever day it
    landed on (the reference only loads today's prefix and misses late flushes).
    """
    from yardstick.sources.files import ENVELOPE_LINE
    reader = spark.readStream.schema(ENVELOPE_LINE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.json(path)
    if topic is not None:  # the folder prunes files, the envelope decides (prefixes of unknown topics are shared)
        prefix = dict(TOPIC_PREFIX).get(topic, UNKNOWN_TOPIC_PREFIX)
        df = df.filter((F.col("lake_prefix") == prefix) & (F.col("batch_metadata.topic") == topic))
    ex = df.select(
        F.col("batch_metadata.topic").alias("topic"),
        F.col("batch_metadata.s3_key").alias("batch_file"),
        F.col("_metadata.file_path").alias("source_file"),
        F.posexplode("records").alias("pos", "m"),
    )
    return ex.select("topic", "batch_file", "source_file", "pos", "m.*")


LEDGER = "batch_id long, topic string, files_written long, records_written long, written_at string"


def lake_sink(path: str, p: PanelParams, clock: Callable[[], str] | None = None, ledger: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer flushing each micro-batch to the lake as envelopes.

    Every micro-batch goes to ``path/batch=<id>/`` and that folder is replaced on
    a replay, so a retried batch leaves no duplicates; ``clock`` gives the
    ``written_at`` stamp (UTC now by default). With ``ledger`` the files and records of each topic (D9), observed while they are
    written, go to ``ledger/batch=<id>``, replaced on a replay as well: a row for each topic that had any.
    """
    from datetime import datetime, timezone

    from yardstick.sources.files import OBSERVED_TOPICS, write_batches

    def write(batch: DataFrame, batch_id: int) -> None:
        stamp = clock() if clock else datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
        seen = Observation(f"flush-{batch_id}") if ledger else None
        write_batches(batch, f"{path.rstrip('/')}/batch={batch_id}", stamp, p, mode="overwrite", batch_id=batch_id, observe=seen)
        if ledger:
            rows = [(batch_id, t, seen.get[f"files_{i}"], seen.get[f"records_{i}"], stamp) for i, t in enumerate(OBSERVED_TOPICS)]
            counts = batch.sparkSession.createDataFrame([r for r in rows if r[2]], LEDGER)  # a row a topic
            counts.coalesce(1).write.mode("overwrite").parquet(f"{ledger.rstrip('/')}/batch={batch_id}")
    return write


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """One row a micro-batch and topic: files and records written, and when."""
    return spark.read.schema(LEDGER).parquet(f"{ledger.rstrip('/')}/*")


# ---- J8: stream upsert keyed by record id --------------------------------------------------------

STREAM_UPDATE = ("value", "extracted_at")


def log_batches(log_path: str, topic: str = TOPIC_VALIDATED) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: valid records of ``topic`` into ``log_path/batch_id=<id>``.

    The partition of a batch id is overwritten on retry, so a replayed
    micro-batch leaves the log unchanged (exactly-once with the checkpoint).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.filter((F.col("topic") == topic) & F.col("decodable")).drop("payload").withColumn(
            "batch_id", F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("batch_id").parquet(log_path)
    return write


LOG_COLS = ("record_id", "goal", "indicator_code", "indicator_name", "country_code", "country_name", "year",
            "value", "unit", "obs_status", "source", "extracted_at", "published_at")


def _log_rows(log: DataFrame) -> DataFrame:
    return log.select(*[C.to_value(c).alias(c) if c == "value" else F.col(c) for c in LOG_COLS],
                      F.concat(F.lit("batch_"), F.col("batch_id").cast("string")).alias("batch_file"),
                      F.col("batch_id").alias("__batch"), "partition", "offset", "timestamp")


def _fold(snapshot: DataFrame | None, log: DataFrame) -> DataFrame:
    # the broker's time first: when the topic gains partitions a key moves, and a backlog holds its messages of both
    # partitions in one micro-batch; without times the batch id, then the partition and offset decide.
    # Snapshot rows precede every log row.
    return upsert(snapshot, _log_rows(log), ["record_id"], list(STREAM_UPDATE), ["timestamp", "__batch", "partition", "offset"])


def latest_snapshot(spark: SparkSession, snapshot_root: str | None) -> tuple[DataFrame | None, int]:
    """The newest complete snapshot (folder ``upto=<batch id>`` with ``_SUCCESS``) and the id it covers."""
    if not snapshot_root:
        return None, -1
    from yardstick.sources.tables import completed_versions
    done = completed_versions(spark, snapshot_root, prefix="upto=")
    if not done:
        return None, -1
    upto = max(done)
    return spark.read.parquet(f"{snapshot_root.rstrip('/')}/upto={upto}"), upto


def current_table(spark: SparkSession, log_path: str, snapshot_root: str | None = None) -> DataFrame:
    """The upserted stream table (H2): the newest snapshot folded with the log
    partitions after it. First arrival keeps every column but value and
    extracted_at, which come from the last arrival in (broker time, batch, partition, offset) order;
    batch_file names the micro-batch of the first arrival."""
    snapshot, upto = latest_snapshot(spark, snapshot_root)
    log = spark.read.parquet(log_path).filter(F.col("batch_id") > upto)
    return _fold(snapshot, log)


def compact(spark: SparkSession, log_path: str, snapshot_root: str) -> int:
    """Fold the log up to its newest batch into a new snapshot; returns the batch id covered.

    Reads then stay bounded by the log written since the last compaction. A
    snapshot without ``_SUCCESS`` (a failed compaction) is never read, and the
    log is never modified, so a compaction can be retried at any time.
    """
    snapshot, upto = latest_snapshot(spark, snapshot_root)
    log = spark.read.parquet(log_path).filter(F.col("batch_id") > upto)
    newest = log.agg(F.max("batch_id")).first()[0]  # one scalar
    if newest is None:
        return upto
    _fold(snapshot, log.filter(F.col("batch_id") <= newest)).write.mode("overwrite") \
        .parquet(f"{snapshot_root.rstrip('/')}/upto={newest}")
    return int(newest)


# ---- J8 on the state store ------------------------------------------------------------------------

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB: on the executors' disks, with changes checkpointed."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def upsert_state(decoded: DataFrame, topic: str = TOPIC_VALIDATED) -> DataFrame:
    """The upserted rows of a decoded stream as a stateful aggregate by record id (J8); run it in update mode.

    The state of a record is its first arrival (all columns) and its last one (value and extracted_at) in
    (broker time, partition, offset) order, so a message that comes late in another micro-batch, or again, changes nothing
    wrongly. The state has one entry a record id, like the table itself; no watermark drops any.
    """
    rows = decoded.filter((F.col("topic") == topic) & F.col("decodable"))
    rows = rows.select(*[C.to_value(c).alias(c) if c == "value" else F.col(c) for c in LOG_COLS], "timestamp", "partition", "offset")
    order = F.struct("timestamp", "partition", "offset")
    kept = [c for c in LOG_COLS if c != "record_id" and c not in STREAM_UPDATE]
    state = rows.groupBy("record_id").agg(F.min_by(F.struct(*kept), order).alias("f"), F.max_by(F.struct(*STREAM_UPDATE), order).alias("l"))
    return state.select(*[F.col("record_id") if c == "record_id" else F.col(f"f.{c}") if c in kept else F.col(f"l.{c}") for c in LOG_COLS])


def bucket_sink(root: str, key: str = "record_id", buckets: int = 32) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of an update-mode stream: a micro-batch's rows replace those of the bucketed table at ``root``.

    Each row is a key's whole new state, so writing a micro-batch again changes nothing; only the buckets
    of its keys are read and written. The micro-batch is written once as a scratch table, so the state is updated once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = stored(batch, f"batch-{batch_id}")
        if not rows.isEmpty():
            if not on_path(spark, root, "exists"):
                create_buckets(rows, root, [key], buckets)
            else:
                upsert_buckets(spark, root, rows, [key], [c for c in rows.columns if c != key], [])
        drop_stored(rows)
    return write


def transport_rows(messages: DataFrame, topic: str = TOPIC_VALIDATED) -> DataFrame:
    """Messages with a partition and an offset -> transport rows (topic, key = country code, JSON value, both, and a timestamp if there is one)."""
    payload = [c for c in R.MESSAGE_FIELDS if c in messages.columns]
    at = [F.col("timestamp")] if "timestamp" in messages.columns else []
    return messages.select(
        F.lit(topic).alias("topic"), F.col("country_code").alias("key"),
        F.to_json(F.struct(*payload)).alias("value"), "partition", "offset", *at)
