"""Upsert, validation, routing, quality checks, files and streaming (hand-written rows + invariants)."""

import time
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF001, rows
from yardstick import schemas
from yardstick.operators import quality as QC
from yardstick.operators import routing as R
from yardstick.operators.upsert import duplicate_keys, upsert
from yardstick.params import REFERENCE, TOPIC_FAILED, TOPIC_VALIDATED
from yardstick.sources import files as FS
from yardstick.streaming import stream as ST


def test_upsert_partial_columns_and_idempotence(spark):
    cur = spark.createDataFrame([("k1", "first", D("1"), "t1"), ("k2", "keep", D("2"), "t1")],
                                "k string, name string, value decimal(18,4), extracted_at string")
    inc = spark.createDataFrame([("k1", "second", D("10"), "t2", 1), ("k1", "third", D("11"), "t3", 2),
                                 ("k3", "new", D("3"), "t2", 1)],
                                "k string, name string, value decimal(18,4), extracted_at string, seq int")
    out = upsert(cur, inc, ["k"], ["value", "extracted_at"], ["seq"])
    assert rows(out) == [("k1", "first", D("11.0000"), "t3"), ("k2", "keep", D("2.0000"), "t1"),
                         ("k3", "new", D("3.0000"), "t2")]
    again = upsert(out, inc, ["k"], ["value", "extracted_at"], ["seq"])
    assert rows(again) == rows(out)
    assert duplicate_keys(out, ["k"]).count() == 0


def msg_df(spark, data):
    fields = ["goal", "indicator_code", "indicator_name", "country_code", "country_name", "country_id", "year",
              "value", "unit", "obs_status", "source", "extracted_at", "record_id", "published_at"]
    full = [dict(zip(fields, [1, "SI.POV.DDAY", "n", "KEN", "Kenya", "KE", 2020, 1.0, None, None, "s", "x",
                              "r", "p"])) | d for d in data]
    return spark.createDataFrame([tuple(d[f] for f in fields) for d in full],
                                 "goal int, indicator_code string, indicator_name string, country_code string, "
                                 "country_name string, country_id string, year int, value double, unit string, "
                                 "obs_status string, source string, extracted_at string, record_id string, "
                                 "published_at string")


def test_validation_first_failure_in_rule_order(spark):
    data = [
        {}, {"goal": None}, {"indicator_code": None}, {"country_code": None}, {"country_name": None},
        {"year": None}, {"value": None}, {"goal": 18}, {"year": 1999}, {"value": -2.0},
        {"value": -2.0, "indicator_code": "NY.GDP.MKTP.KD.ZG"}, {"country_code": "KENYA"},
        {"goal": 0, "year": 2031},  # two at once: goal first
    ]
    got = [r.failure_reason for r in R.validate(msg_df(spark, data), REFERENCE).collect()]
    assert got == [None, "Missing required field: goal", "Missing required field: indicator_code",
                   "Missing required field: country_code", "Missing required field: country_name",
                   "Missing required field: year", "Missing required field: value", "Invalid goal number: 18",
                   "Invalid year: 1999", "Unexpected negative value: -2.0", None, "Invalid country code: KENYA",
                   "Invalid goal number: 0"]


def test_fan_out_count_invariant_and_dead_letter(spark):
    data = [{"country_code": "KEN"}, {"country_code": "FRA"}, {"country_code": None}, {"year": 1990}]
    v = R.validate(msg_df(spark, data), REFERENCE)
    routed = R.fan_out(v, REFERENCE.members, REFERENCE)
    valid = v.filter("valid").count()
    members = v.filter(F.col("valid") & F.col("country_code").isin(*REFERENCE.members)).count()
    invalid = v.filter("not valid").count()
    assert routed.count() == 3 * valid + members + invalid
    dead = routed.filter(F.col("topic") == TOPIC_FAILED).select(F.get_json_object("value", "$.failure_reason")).collect()
    assert sorted(r[0] for r in dead) == ["Invalid year: 1990", "Missing required field: country_code"]
    # payload round-trips through the message schema
    back = routed.filter(F.col("topic") == TOPIC_VALIDATED).select(F.from_json("value", schemas.MESSAGE).alias("m"))
    assert sorted(r.m.country_code for r in back.collect()) == ["FRA", "KEN"]
    st = R.publish_stats(routed).first()
    assert (st.records_published, st.records_failed) == (2, 2)


def test_gate_raises_and_column_tests(spark):
    rb = spark.createDataFrame([("X", "n", 1, "", "c", 1999, D("-1"), None, None, "s", "e", None)],
                               schemas.RAW_BATCH)
    rs = spark.createDataFrame([], schemas.RAW_STREAM)
    rep = QC.gate_report(rb, rs, REFERENCE, "2026-03-30 00:00:00")
    got = dict((r.check_name, (r.observed, r.passed)) for r in rep.collect())
    assert got == {"min_rows": (1, False), "no_null_codes": (1, False), "year_range": (1, False),
                   "no_unexpected_negatives": (1, False), "recent_stream_rows": (0, False)}
    with pytest.raises(QC.GateFailed):
        QC.gate(rep)
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    assert rows(QC.column_tests({"t": df}, (("t", ("c",), ("c",)),)), "test", "failures") == \
        [("not_null", 1), ("unique", 1)]


def test_api_replies_normalise(spark):
    replies = spark.createDataFrame([
        ("SI.POV.DDAY", '[{"page":1,"pages":1},[{"countryiso3code":"KEN","country":{"id":"KE","value":"Kenya"},'
                        '"date":"2019","value":36.1,"unit":null,"obs_status":""},null,'
                        '{"countryiso3code":"TZA","country":{"id":"TZ","value":"Tanzania"},"date":"2019","value":null}]]'),
        ("SI.POV.DDAY", '[{"message":[{"id":"120","value":"Invalid value"}]}]'),
        ("XX.UNKNOWN", '[{"page":1},[{"countryiso3code":"KEN","date":"2018","value":2}]]'),
        ("SI.POV.DDAY", '[{"page":1,"pages":0},null]'),
    ], "indicator_code string, reply string")
    dic = spark.createDataFrame([("SI.POV.DDAY", 1, "Poverty")], schemas.INDICATORS)
    out = FS.normalise_api_pages(replies, dic, "now")
    assert rows(out, "goal", "indicator_code", "indicator_name", "country_code", "country_name", "country_id",
                "year", "value", "unit", "obs_status") == \
        sorted([(1, "SI.POV.DDAY", "Poverty", "KEN", "Kenya", "KE", 2019, 36.1, None, ""),   # JSON null kept
                (None, "XX.UNKNOWN", "", "KEN", "", "", 2018, 2.0, "", "")], key=repr)        # missing -> ''
    nodate = spark.createDataFrame([("SI.POV.DDAY", '[{},[{"countryiso3code":"KEN","value":1}]]')],
                                   "indicator_code string, reply string")
    assert FS.normalise_api_pages(nodate, dic, "now").first().year == 0  # int(raw.get("date", 0))


def test_multiline_json_array_file(spark, tmp_path):
    p = tmp_path / "obs.json"
    p.write_text('[\n {"goal": 13, "indicator_code": "EN.CLC.MDAT.ZS", "country_code": "KEN", "year": 2009,'
                 ' "value": 1.5, "unit": null},\n {"goal": 13, "indicator_code": "EN.CLC.MDAT.ZS",'
                 ' "country_code": "NGA", "year": 2009, "value": 0.0}\n]')
    df = FS.read_observations(spark, str(p), multiline=True)
    assert rows(df, "country_code", "value") == [("KEN", 1.5), ("NGA", 0.0)]


def _transport(spark, values, offset0=0):
    return spark.createDataFrame([(TOPIC_VALIDATED, "k", v, 0, offset0 + i) for i, v in enumerate(values)],
                                 ST.TRANSPORT)


def test_stream_undecodable_goes_to_dead_letter_and_restart_adds_nothing(spark, tmp_path):
    good = ('{"goal":1,"indicator_code":"SI.POV.DDAY","indicator_name":"n","country_code":"KEN",'
            '"country_name":"Kenya","year":2020,"value":3.5,"record_id":"r1","extracted_at":"e1"}')
    good2 = good.replace('"value":3.5', '"value":4.5').replace('"e1"', '"e2"')
    src_dir, ckpt, out, log = (str(tmp_path / n) for n in ("in", "ckpt", "out", "log"))
    _transport(spark, [good, "{not json", "[1,2]"]).write.json(f"{src_dir}/a")
    dec = ST.decode(ST.read_topics(spark, [TOPIC_VALIDATED], {"format": "json", "path": src_dir + "/*"}))
    q = dec.writeStream.option("checkpointLocation", ckpt).foreachBatch(ST.log_batches(log)) \
        .trigger(availableNow=True).start()
    ST.run_once(q)
    routed = ST.with_batch_metrics(ST.route_stream(dec, REFERENCE.members, REFERENCE))
    q2 = ST.start(routed, {"format": "parquet", "path": out}, ckpt + "-route")
    ST.run_once(q2)
    m = q2.lastProgress["observedMetrics"]["routing"]
    assert (int(m["messages"]), int(m["failed"])) == (6, 2)  # 1 valid x 4 topics + 2 undecodable
    dead = spark.read.parquet(out).filter(F.col("topic") == TOPIC_FAILED)
    assert dead.count() == 2  # both undecodable messages routed, none lost
    t1 = rows(ST.current_table(spark, log), "record_id", "value", "extracted_at")
    assert t1 == [("r1", D("3.5000"), "e1")]
    # restart with nothing new: no change
    q = dec.writeStream.option("checkpointLocation", ckpt).foreachBatch(ST.log_batches(log)) \
        .trigger(availableNow=True).start()
    ST.run_once(q)
    assert rows(ST.current_table(spark, log), "record_id", "value", "extracted_at") == t1
    # a later arrival updates value and extracted_at only
    time.sleep(1.1)
    _transport(spark, [good2], offset0=10).write.json(f"{src_dir}/b")
    q = dec.writeStream.option("checkpointLocation", ckpt).foreachBatch(ST.log_batches(log)) \
        .trigger(availableNow=True).start()
    ST.run_once(q)
    t2 = ST.current_table(spark, log).first()
    assert (t2.value, t2.extracted_at, t2.batch_file) == (D("4.5000"), "e2", "batch_0")


def test_batch_equals_stream_on_driver_tables(spark):
    """The same messages through 1 file and through several arrivals give the batch upsert."""
    import __spark_entry__ as E
    a = E.queries()["stream_upsert"](spark, SF001)
    b = E.queries()["raw_stream_upsert"](spark, SF001).drop("batch_file", "created_at")
    assert rows(a) == rows(b.select(*a.columns))


def test_processing_time_trigger_and_landing_pruning(spark, tmp_path):
    """A processing-time consumer picks up arrivals until stopped; A4: one day read back with pruning."""
    src_dir, ckpt, out = (str(tmp_path / n) for n in ("in", "ckpt", "out"))
    good = ('{"goal":1,"indicator_code":"SI.POV.DDAY","indicator_name":"n","country_code":"KEN",'
            '"country_name":"Kenya","year":2020,"value":3.5,"record_id":"r1"}')
    _transport(spark, [good]).write.json(f"{src_dir}/a")
    dec = ST.decode(ST.read_topics(spark, [TOPIC_VALIDATED], {"format": "json", "path": src_dir + "/*"}))
    q = ST.run_stream(dec.drop("payload"), {"format": "parquet", "path": out}, ckpt, interval="1 second")
    try:
        q.processAllAvailable()
        _transport(spark, [good], offset0=5).write.json(f"{src_dir}/b")
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == 2

    obs = spark.createDataFrame([(1, "X", "n", "KEN", "Kenya", "KE", 2020, 1.0, None, None, "s", "e")],
                                schemas.OBSERVATION)
    base = str(tmp_path / "landing")
    FS.write_landing(obs, base, "2026-03-29 10:00:00")
    FS.write_landing(obs, base, "2026-03-30 10:00:00")
    FS.write_landing(obs, base, "2026-03-30 18:00:00")  # same day again: replaced, not duplicated
    FS.write_landing(obs.withColumn("indicator_code", F.lit("Y.1")), base, "2026-03-30 19:00:00")  # another indicator: added
    day = FS.read_landing(spark, base, "2026/03/30")
    assert rows(day, "indicator_code") == [("X",), ("Y.1",)] and FS.read_landing(spark, base).count() == 3
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(d" in plan


def _consumed(routed, partition=0):
    """Routed messages with a consumption order."""
    w = Window.partitionBy("topic").orderBy("key", "value")
    return routed.withColumn("partition", F.lit(partition)).withColumn("offset", F.row_number().over(w).cast("long") - 1)


def test_envelopes_keep_order_and_bound(spark, tmp_path):
    """200 updates of one record over several chunks and two flushes in the same second: the last one wins."""
    p = REFERENCE.with_(max_records_per_object=20)
    msg = spark.range(200).select(
        F.lit(TOPIC_VALIDATED).alias("topic"), F.lit("KEN").alias("key"),
        F.to_json(F.struct(F.lit("r1").alias("record_id"), F.col("id").cast("double").alias("value"),
                           F.concat(F.lit("e"), F.col("id")).alias("extracted_at"))).alias("value"),
        F.lit(0).alias("partition"), F.col("id").alias("offset")).repartition(7)
    lake = str(tmp_path / "lake")
    FS.write_batches(msg.filter("offset < 110"), lake, "2026-03-30T12:00:00", p, batch_id=3)
    FS.write_batches(msg.filter("offset >= 110"), lake, "2026-03-30T12:00:00", p, batch_id=4)
    back = FS.read_batches(spark, lake, TOPIC_VALIDATED)
    assert back.select("batch_file", "pos").distinct().count() == 200
    assert max(r["count"] for r in back.groupBy("batch_file").count().collect()) <= 20
    got = FS.load_records(back).collect()
    assert [(r.value, r.extracted_at) for r in got] == [(D("199.0000"), "e199")]
    assert got[0].batch_file.endswith("_000003_00000_000000000000.json")
    assert rows(FS.batch_stats(back), "files_written", "records_written") == [(11, 200)]
    with pytest.raises(ValueError):
        FS.write_batches(msg.drop("offset"), lake, "2026-03-30T12:00:00", p)
    stream = ST.lake_stream(spark, lake, TOPIC_VALIDATED)
    assert "lake_prefix" in stream._jdf.queryExecution().analyzed().toString()


def test_partition_growth_keeps_the_newer_value(spark, tmp_path):
    """A key moves to a lower partition when the topic gains partitions: the later batch still wins."""
    log = str(tmp_path / "log")
    msg = '{{"country_code":"KEN","year":2020,"value":{v},"record_id":"r1","extracted_at":"e{v}"}}'
    writer = ST.log_batches(log)
    for batch_id, (part, off, v) in enumerate([(2, 50, 1), (0, 0, 2)]):
        rows_ = spark.createDataFrame([(TOPIC_VALIDATED, "KEN", msg.format(v=v), part, off)], ST.TRANSPORT)
        writer(ST.decode(rows_), batch_id)
    assert rows(ST.current_table(spark, log), "value", "extracted_at") == [(D("2.0000"), "e2")]


def test_null_dates_stay_in_two_loads(spark, tmp_path):
    import __spark_entry__ as E
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    holes = li.withColumn("l_shipdate", F.when(F.col("l_orderkey") % 10 == 0, None).otherwise(F.col("l_shipdate")))
    holes.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = E.queries()["upsert_two_loads"](spark, str(tmp_path))
    assert got.count() == li.select("l_orderkey", "l_linenumber").distinct().count()


def test_building_models_starts_no_job(spark):
    from yardstick.plans.models import Panel
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "plans only")
    try:
        p = Panel(spark, SF001)
        for name in ("combined", "tracker", "peer_comparison", "goal_summary"):
            getattr(p, name)
        assert len(tracker.getJobIdsForGroup("build")) == 0
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_completed_versions_are_never_replaced(spark, tmp_path):
    from yardstick.sources.tables import write_version
    df = spark.range(3)
    write_version(df, str(tmp_path / "t"), 1)
    with pytest.raises(FileExistsError):
        write_version(df, str(tmp_path / "t"), 1)
    (tmp_path / "t" / "v=2").mkdir()  # interrupted
    write_version(df, str(tmp_path / "t"), 2)


def test_lake_sink_replay_is_idempotent(spark, tmp_path):
    data = [{"country_code": "KEN"}, {"country_code": "FRA"}, {"year": 1990}]
    routed = R.fan_out(R.validate(msg_df(spark, data), REFERENCE), REFERENCE.members, REFERENCE)
    routed = _consumed(routed)
    sink = ST.lake_sink(str(tmp_path / "lake"), REFERENCE, clock=lambda: "2026-03-30T12:00:00")
    sink(routed, 7)
    sink(routed, 7)  # the same micro-batch replayed after a failure
    sink(routed, 8)
    back = FS.read_batches(spark, str(tmp_path / "lake"))
    assert back.count() == 2 * routed.count()
    assert rows(back.groupBy("topic").count()) == rows(routed.groupBy("topic").count().select(
        "topic", (F.col("count") * 2).alias("count")))


def test_stream_table_compaction(spark, tmp_path):
    """Snapshot + newer log equals the fold of the whole log; reads after compaction skip old batches."""
    log, snaps = str(tmp_path / "log"), str(tmp_path / "snap")
    msg = ('{{"goal":1,"indicator_code":"X","indicator_name":"n","country_code":"KEN","country_name":"Kenya",'
           '"year":2020,"value":{v},"record_id":"{r}","extracted_at":"e{v}"}}')
    writer = ST.log_batches(log)
    for batch_id, (r, v, off) in enumerate([("r1", 1, 0), ("r2", 2, 1), ("r1", 3, 2), ("r3", 4, 3)]):
        writer(ST.decode(_transport(spark, [msg.format(r=r, v=v)], offset0=off)), batch_id)
        if batch_id == 1:
            assert ST.compact(spark, log, snaps) == 1
    full = rows(ST.current_table(spark, log), "record_id", "value", "extracted_at", "batch_file")
    assert full == [("r1", D("3.0000"), "e3", "batch_0"), ("r2", D("2.0000"), "e2", "batch_1"),
                    ("r3", D("4.0000"), "e4", "batch_3")]
    assert rows(ST.current_table(spark, log, snaps), "record_id", "value", "extracted_at", "batch_file") == full
    assert ST.compact(spark, log, snaps) == 3
    assert rows(ST.current_table(spark, log, snaps), "record_id", "value", "extracted_at", "batch_file") == full
    assert ST.compact(spark, log, snaps) == 3  # nothing new


def test_indicator_tree_and_lake_provenance(spark, tmp_path):
    obs = spark.createDataFrame([(1, "SI.POV.DDAY", "n", "KEN", "Kenya", "KE", 2020, 1.0, None, None, "s", "e"),
                                 (3, "SH.DYN.MORT", "n", "KEN", "Kenya", "KE", 2020, 2.0, None, None, "s", "e")],
                                schemas.OBSERVATION)
    FS.write_observations(obs, str(tmp_path / "obs"))
    folders = sorted(p.name for p in (tmp_path / "obs" / "by_indicator").iterdir() if p.is_dir())
    assert folders == ["indicator_slug=SH_DYN_MORT", "indicator_slug=SI_POV_DDAY"]
    assert FS.read_observations(spark, str(tmp_path / "obs" / "combined")).count() == 2

    data = [{"country_code": "KEN", "record_id": "a"}, {"country_code": "FRA", "record_id": "b"}]
    routed = _consumed(R.fan_out(R.validate(msg_df(spark, data), REFERENCE), REFERENCE.members, REFERENCE))
    FS.write_batches(routed, str(tmp_path / "lake"), "2026-03-30T12:00:00", REFERENCE)
    back = FS.read_batches(spark, str(tmp_path / "lake"), TOPIC_VALIDATED)
    got = back.select("record_id", "batch_file", "source_file", "pos").collect()
    assert sorted(r.record_id for r in got) == ["a", "b"]
    assert all(r.batch_file.startswith("streaming/kafka-batches/validated/2026/03/30/batch_20260330_120000_")
               and r.source_file.endswith(".json") and r.pos >= 0 for r in got)


def test_versioned_table_upsert_and_failed_write(spark, tmp_path):
    from yardstick.sources.tables import current_version, upsert_into
    root = str(tmp_path / "t")
    first = spark.createDataFrame([("k1", "a", D("1"), 0), ("k2", "b", D("2"), 1)],
                                  "k string, name string, value decimal(18,4), seq int")
    assert upsert_into(spark, root, first, ["k"], ["value"], ["seq"]) == 1
    second = spark.createDataFrame([("k1", "z", D("5"), 0), ("k3", "c", D("3"), 1)],
                                   "k string, name string, value decimal(18,4), seq int")
    assert upsert_into(spark, root, second, ["k"], ["value"], ["seq"]) == 2
    (tmp_path / "t" / "v=3").mkdir()  # an interrupted write: no _SUCCESS
    table, version = current_version(spark, root)
    assert version == 2
    assert rows(table) == [("k1", "a", D("5.0000")), ("k2", "b", D("2.0000")), ("k3", "c", D("3.0000"))]
