"""Bucketed tables, stateful upsert, ranks of unbounded measures, offset audits, flush ledgers and bounded consumers."""

import random
import time
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from yardstick.operators import offsets as OF
from yardstick.operators import ranking as RK
from yardstick.operators import routing as R
from yardstick.operators.upsert import upsert
from yardstick.params import REFERENCE, TOPIC_VALIDATED
from yardstick.sources import buckets as BK
from yardstick.streaming import stream as ST

TABLE = "k long, part string, name string, value decimal(18,4)"
LOAD = "k int, part string, name string, value decimal(18,4), seq int"  # narrower keys than the table's


def _table(spark, n=200):
    return spark.createDataFrame([(i, "p", f"n{i}", D(i)) for i in range(n)], TABLE)


def _load(spark):
    return spark.createDataFrame([(3, "p", "late", D("30"), 2), (3, "p", "early", D("20"), 1), (500, "p", "new", D("5"), 1),
                                  (500, "p", "newer", D("6"), 2), (3, "q", "other", D("1"), 1)], LOAD)


def _files(root):
    return {p.relative_to(root): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def test_upsert_touches_only_the_buckets_of_its_keys(spark, tmp_path):
    root = str(tmp_path / "t")
    BK.create_buckets(_table(spark), root, ["k", "part"], 16)
    before = _files(root)
    assert len({p.parts[1] for p in before}) == 16
    touched = BK.upsert_buckets(spark, root, _load(spark), ["k", "part"], ["value"], ["seq"])
    after = _files(root)
    kept = {p: t for p, t in before.items() if int(p.parts[1].split("=")[1]) not in touched}
    assert 1 <= len(touched) <= 3 and len(kept) >= 13
    assert {p: t for p, t in after.items() if p in kept} == kept  # the same files, not written again
    assert not set(after) & (set(before) - set(kept))  # and no old version of the others
    assert not (tmp_path / "t" / "_pending").exists()
    want = upsert(_table(spark), _load(spark).withColumn("k", F.col("k").cast("long")), ["k", "part"], ["value"], ["seq"])
    assert rows(BK.read_buckets(spark, root)) == rows(want)
    assert BK.upsert_buckets(spark, root, _load(spark), ["k", "part"], ["value"], ["seq"]) == touched  # a replay
    assert rows(BK.read_buckets(spark, root)) == rows(want)
    assert BK.upsert_buckets(spark, root, _load(spark).limit(0), ["k", "part"], ["value"], ["seq"]) == []


def test_merge_reads_only_touched_buckets(spark, tmp_path):
    root = str(tmp_path / "t")
    BK.create_buckets(_table(spark), root, ["k", "part"], 16)
    one = spark.read.parquet(root).where(F.col(BK.BUCKET).isin([3]))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and BK.BUCKET in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(f"{BK.BUCKET}=3/" in r[0] for r in one.select("_metadata.file_path").distinct().collect())


def test_a_writer_that_dies_while_replacing_loses_nothing(spark, tmp_path, monkeypatch):
    import shutil
    root = str(tmp_path / "t")
    BK.create_buckets(_table(spark), root, ["k", "part"], 8)
    with monkeypatch.context() as m:
        calls = iter([BK._put_in_place, lambda *_: (_ for _ in ()).throw(RuntimeError("died"))])
        m.setattr(BK, "_put_in_place", lambda *a: next(calls)(*a))
        with pytest.raises(RuntimeError):
            BK.upsert_buckets(spark, root, _load(spark), ["k", "part"], ["value"], ["seq"])
    touched = {p.parts[1] for p in (q.relative_to(tmp_path / "t" / "_pending") for q in (tmp_path / "t" / "_pending").rglob("*.parquet"))}
    shutil.rmtree(tmp_path / "t" / "__of=8" / sorted(touched)[0])  # it had removed a bucket's old files
    other = spark.createDataFrame([(7, "p", "x", D("70"), 1)], LOAD)
    BK.upsert_buckets(spark, root, other, ["k", "part"], ["value"], ["seq"])
    keyed = lambda df: df.withColumn("k", F.col("k").cast("long"))
    want = upsert(upsert(_table(spark), keyed(_load(spark)), ["k", "part"], ["value"], ["seq"]), keyed(other), ["k", "part"], ["value"], ["seq"])
    assert rows(BK.read_buckets(spark, root)) == rows(want)


# ---- order of arrivals, state ----

MSG = '{{"country_code":"KEN","year":2020,"value":{v},"record_id":"{r}","extracted_at":"e{v}","indicator_name":"n{v}"}}'


def _timed(spark, data):
    """(record, value, partition, offset, seconds)"""
    df = spark.createDataFrame([(TOPIC_VALIDATED, "KEN", MSG.format(r=r, v=v), p, o, s) for r, v, p, o, s in data],
                               "topic string, key string, value string, partition int, offset long, s long")
    return df.select("topic", "key", "value", "partition", "offset", F.timestamp_seconds("s").alias("timestamp"))


def test_a_backlog_over_a_grown_topic_keeps_the_newer_value(spark, tmp_path):
    """One micro-batch holds a key's messages of its old partition and of its new, lower one: the broker's time decides."""
    log = str(tmp_path / "log")
    ST.log_batches(log)(ST.decode(_timed(spark, [("r", 1, 2, 5, 100), ("r", 2, 0, 0, 200)])), 0)
    got = ST.current_table(spark, log)
    assert rows(got, "value", "extracted_at", "indicator_name") == [(D("2.0000"), "e2", "n1")]
    lake = str(tmp_path / "lake")
    from yardstick.sources import files as FS
    FS.write_batches(_timed(spark, [("r", 1, 2, 5, 100), ("r", 2, 0, 0, 200)]), lake, "2026-03-30T12:00:00", REFERENCE)
    got = FS.load_records(FS.read_batches(spark, lake, TOPIC_VALIDATED))
    assert rows(got, "value", "extracted_at", "indicator_name") == [(D("2.0000"), "e2", "n1")]


def test_stateful_upsert_over_restarts(spark, tmp_path):
    """Late, repeated and moved messages over four runs; state survives each stop; untouched keys keep their files."""
    src_dir, ckpt, out = (str(tmp_path / d) for d in ("in", "ckpt", "out"))
    data = [("a", 1, 2, 0, 10), ("b", 2, 2, 1, 20), ("a", 3, 2, 2, 30), ("c", 4, 1, 0, 40), ("a", 5, 0, 0, 50), ("b", 6, 0, 1, 5),
            ("a", 1, 2, 0, 10), ("d", 7, 1, 1, 60)]  # b's message of time 5 comes late, a's first again
    for turn, part in enumerate((data[:3], data[3:5], data[5:7], data[7:])):
        _timed(spark, part).write.json(f"{src_dir}/{turn}")
        with ST.rocksdb_state(spark):
            decoded = ST.decode(ST.read_topics(spark, [TOPIC_VALIDATED], {"format": "json", "path": f"{src_dir}/*"}))
            q = ST.upsert_state(decoded).writeStream.outputMode("update").option("checkpointLocation", ckpt) \
                .foreachBatch(ST.bucket_sink(out, buckets=8)).trigger(availableNow=True).start()
            ST.run_once(q)
        assert any(k.startswith("rocksdb") for k in q.lastProgress["stateOperators"][0]["customMetrics"])
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or "")
    got = rows(BK.read_buckets(spark, out), "record_id", "value", "extracted_at", "indicator_name")
    assert got == [("a", D("5.0000"), "e5", "n1"), ("b", D("2.0000"), "e2", "n6"), ("c", D("4.0000"), "e4", "n4"), ("d", D("7.0000"), "e7", "n7")]


# ---- ranks ----

def _brute_ranks(data):
    out = []
    for g, m, i in data:
        own = [x for h, x, _ in data if h == g]
        better = sum(x is None and m is not None or (x is not None and m is not None and x > m) for x in own)
        some = [x for x in own if x is not None]
        out.append((g, m, i, better + 1, len(some), D(sum(some)) if some else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 3, 17])
def test_ranks_with_ties_and_nulls(spark, ranges):
    rng = random.Random(ranges)
    data = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 7, rng.randrange(-50, 50), rng.randrange(10 ** 12)]), i) for i in range(400)]
    df = spark.createDataFrame(data, "g string, m long, i int")
    got = RK.rank_within(df, ["g"], "m", ranges)
    assert sorted([(r.g, r.m, r.i, r["rank"], r.group_n, None if r.group_total is None else D(r.group_total)) for r in got.collect()], key=repr) == [
        (*x[:5], None if x[5] is None else x[5].quantize(D("0.0001"))) for x in _brute_ranks(data)]
    assert RK.rank_within(df.limit(0), ["g"], "m", ranges).collect() == []


def test_no_task_holds_a_group_or_a_heavy_value(spark):
    """All rows in one group and half of them one value: windows see a range of values, the join deals the ties."""
    df = spark.range(40_000).select(F.lit("g").alias("g"), F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("m"), "id")
    got = RK.rank_within(df, ["g"], "m", 8)
    assert got.groupBy("rank").count().where("count > 1").collect()[0]["count"] == 20_001
    assert got.where("m = 5").select("rank").distinct().collect()[0][0] == 20_000 - 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__range" in plan  # the window's partitioning is the range, not the group
    sizes = got.groupBy(F.pmod(F.xxhash64("g", "m", "id"), F.lit(RK.SLICES))).count().collect()
    assert max(r["count"] for r in sizes) < 2 * 40_000 / RK.SLICES


def test_numbers_by_time(spark):
    rng = random.Random(2)
    data = [(rng.randrange(3), rng.choice([None, 1_700_000_000 + rng.randrange(600)]), i) for i in range(500)]
    df = spark.createDataFrame(data, "k int, s long, i int").withColumn("t", F.timestamp_seconds("s"))
    got = {r.i: r.n for r in RK.numbered_by_time(df, "k", "t", "i", "n").collect()}
    for k in range(3):
        own = sorted([d for d in data if d[0] == k], key=lambda d: (d[1] is not None, d[1] or 0, d[2]))
        assert [got[d[2]] for d in own] == list(range(len(own)))


# ---- offsets ----

def _brute_audit(records):
    out = []
    for p in {p for p, _ in records}:
        own = [o for q, o in records if q == p]
        n = {o: own.count(o) for o in own}
        for kind, wanted in (("missing", lambda o: o not in n), ("redelivered", lambda o: n.get(o, 0) > 1)):
            run = []
            for o in [*range(min(own), max(own) + 1), None]:
                if o is not None and wanted(o):
                    run.append(o)
                elif run:
                    out.append(("t", p, kind, run[0], run[-1], len(run), sum(n.get(x, 0) for x in run)))
                    run = []
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1, 4, 16, 1 << 16])
def test_offset_audit_against_brute_force(spark, block):
    rng = random.Random(block)
    records = [(p, o) for p in (0, 1, 2) for o in range(p * 7, 150) if not (20 < o < 55 or rng.random() < 0.1)]
    records += [r for r in records if 60 <= r[1] < 90 or rng.random() < 0.1]  # a replayed flush, and single ones
    df = spark.createDataFrame([("t", p, o) for p, o in records] + [("t", 0, None)], "topic string, partition int, offset long")
    assert rows(OF.offset_audit(df, block)) == _brute_audit(records)
    assert OF.offset_audit(df.limit(0)).collect() == []


# ---- ledger, bounded consumer, dead letter ----

def test_flush_ledger_has_a_row_a_batch_and_topic_and_survives_a_replay(spark, tmp_path):
    from yardstick.sources import files as FS
    lake, ledger = str(tmp_path / "lake"), str(tmp_path / "ledger")
    routed = _timed(spark, [("r", v, v % 3, v, v) for v in range(60)])
    p = REFERENCE.with_(max_records_per_object=5)
    sink = ST.lake_sink(lake, p, clock=lambda: "2026-03-30T12:00:00", ledger=ledger)
    for batch_id, part in ((0, routed.where("offset < 20")), (1, routed.where("offset >= 20")), (1, routed.where("offset >= 20"))):
        sink(part, batch_id)
    got = rows(ST.read_ledger(spark, ledger), "batch_id", "topic", "files_written", "records_written")
    back = FS.read_batches(spark, lake).withColumn("batch", F.regexp_extract("source_file", "batch=(\\d+)/", 1).cast("long"))
    want = rows(back.groupBy("batch", "topic").agg(F.count_distinct("batch_file"), F.count("*")))
    assert got == want and sum(r[3] for r in got) == 60 and [r[0] for r in got] == [0, 1]


def test_bounded_consumer_takes_batches_of_limited_bytes(spark, tmp_path):
    src_dir, ckpt, out = (str(tmp_path / d) for d in ("in", "ckpt", "out"))
    for i in range(6):
        _timed(spark, [("r", i * 10 + j, 0, i * 10 + j, i) for j in range(10)]).coalesce(1).write.json(f"{src_dir}/{i}")
    size = max(p.stat().st_size for p in Path(src_dir).rglob("*.json"))

    def consume():
        stream = ST.read_topics(spark, [TOPIC_VALIDATED], {"format": "json", "path": f"{src_dir}/*", "maxBytesPerTrigger": str(2 * size)})
        return ST.run_stream(stream, {"format": "parquet", "path": out}, ckpt, interval="1 second")

    q = consume()
    until = time.time() + 60
    while not q.recentProgress and time.time() < until:
        time.sleep(0.1)
    q.stop()
    _timed(spark, [("r", 99, 0, 99, 9)]).coalesce(1).write.json(f"{src_dir}/late")
    q = consume()
    q.processAllAvailable()
    batches = [b["numInputRows"] for b in q.recentProgress if b["numInputRows"]]
    q.stop()
    assert max(batches) <= 20  # two files of ten
    assert sorted(r.offset for r in spark.read.parquet(out).collect()) == [*range(60), 99]


def test_values_out_of_range_go_to_dead_letter(spark):
    data = [(1, "SI.POV.DDAY", "n", "KEN", "Kenya", 2020, v) for v in (1e20, -9.9e19, 9.9e19, float("inf"), float("nan"), 1.0)]
    df = spark.createDataFrame(data, "goal int, indicator_code string, indicator_name string, country_code string, country_name string, year int, value double")
    p = REFERENCE.with_(exempt_metrics=("SI.POV.DDAY",))
    got = R.validate(df, p).collect()
    assert [r.failure_reason for r in got] == [R.OUT_OF_RANGE, None, None, R.OUT_OF_RANGE, R.OUT_OF_RANGE, None]
    assert R.out_of_range(df).count() == 3


def test_change_between_values_of_both_signs(spark):
    from yardstick.operators import progress as P
    base = "country_code string, country_name string, indicator_code string, indicator_name string, goal int, goal_title string, year int, value decimal(24,4), is_african_country boolean"
    big = D("90000000000000000000")
    df = spark.createDataFrame([("K", "k", "i", "i", 1, "g", y, v, True) for y, v in ((2000, -big), (2001, big), (2002, -big))], base)
    got = rows(P.year_over_year(df), "year", "absolute_change", "pct_change")
    assert got == [(2001, D("180000000000000000000.0000"), D("200.00")), (2002, D("-180000000000000000000.0000"), D("-200.00"))]


# ---- bucketed panel, variants, two-phase upsert, hot members ----

def test_the_merge_and_its_consumers_exchange_nothing(spark):
    from tests.conftest import SF001
    from yardstick.plans.catalog_stored import bucketed_panel
    panel = bucketed_panel(spark, SF001, 8)
    for df in (panel.combined, panel.yoy):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        series = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "country_code" in x]
        assert not series


def test_variant_replies_tell_missing_from_null(spark):
    from yardstick.sources import files as FS
    replies = ['[{"page":1},[{"countryiso3code":"KEN","country":{"id":"KE","value":"Kenya"},"date":"2020","value":1.5,"unit":null,"obs_status":"A"},'
               '{"country":{"id":"KE"},"value":2},{"countryiso3code":"FRA","date":"2020","value":null},null]]',
               '[{"message":"error"}]', "not json", '[{"page":1},null]', '{"a":1}', None,
               '[{"page":1},[{"countryiso3code":"UGA","country":null,"date":"x","value":"3.25","unit":"%","obs_status":7}]]']
    raw = spark.createDataFrame([("SI.POV.DDAY", r) for r in replies], "indicator_code string, reply string")
    d = spark.createDataFrame([("SI.POV.DDAY", 1, "Poverty")], "indicator_code string, goal int, indicator_name string")
    got, want = (rows(f(raw, d, "t")) for f in (FS.normalise_api_variant, FS.normalise_api_pages))
    assert [(r[3], r[4], r[6], r[7], r[8], r[9]) for r in sorted(got, key=lambda r: r[7])] == [
        ("KEN", "Kenya", 2020, 1.5, None, "A"), ("", "", 0, 2.0, "", ""), ("UGA", "", None, 3.25, "%", "7")]
    assert got == want


def test_two_phase_upsert_equals_upsert(spark):
    from yardstick.operators.upsert import upsert_two_phase
    rng = random.Random(9)
    data = [(rng.choice(["hot", "hot", "hot", f"k{rng.randrange(40)}", None]), f"n{i}", D(i), rng.choice([None, 5, 9, -3]), i) for i in range(600)]
    inc = spark.createDataFrame(data, "k string, name string, value decimal(18,4), s long, seq long").withColumn("t", F.timestamp_seconds("s"))
    inc = inc.drop("s")
    cur = spark.createDataFrame([("hot", "kept", D("-1")), ("only", "o", D("-2"))], "k string, name string, value decimal(18,4)")
    for current in (None, cur):
        got = upsert_two_phase(current, inc, ["k"], ["value"], ["t", "seq"])
        assert rows(got) == rows(upsert(current, inc, ["k"], ["value"], ["t", "seq"]))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert rows(upsert_two_phase(cur, inc.limit(0), ["k"], ["value"], ["t", "seq"])) == rows(cur)
    with pytest.raises(ValueError):
        upsert_two_phase(cur, inc, ["k"], ["value"], ["t", "seq", "name"])


def test_a_hot_key_of_the_two_phase_upsert_is_dealt_over_tasks(spark):
    """All rows of one key: the join that finds its winners is partitioned by key and arrival."""
    from yardstick.operators.upsert import _packed, upsert_two_phase
    inc = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("name"), F.col("id").alias("value"), F.col("id").alias("seq"))
    assert rows(upsert_two_phase(None, inc, ["k"], ["value"], ["seq"])) == [("hot", "0", 19_999)]
    parts = inc.select("k", _packed(inc, ["seq"]).alias("at")).repartition(16, "k", "at").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 16 and max(r["count"] for r in parts) < 2 * 20_000 / 16


def test_a_country_with_half_of_all_messages_is_dealt_over_tasks(spark):
    from yardstick.operators.dims import member_flag
    msgs = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, "HOT").otherwise(F.concat(F.lit("C"), (F.col("id") % 997).cast("string"))).alias("code"), "id")
    members = spark.range(997).where("id % 3 = 0").select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("code")).union(
        spark.createDataFrame([("HOT",)], "code string"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        tasks = lambda s: member_flag(msgs, "code", members, "m", salts=s).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count_if("m"))
        got = {s: [r.n for r in tasks(s).collect()] for s in (1, R.SALTS)}
        flags = {s: member_flag(msgs, "code", members, "m", salts=s).where("m").count() for s in (1, R.SALTS)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(got[1]) >= 20_000 and max(got[R.SALTS]) < 2 * sorted(got[R.SALTS])[len(got[R.SALTS]) // 2]
    assert flags[1] == flags[R.SALTS] and sum(got[R.SALTS]) == 40_000


def test_copies_of_members_are_never_broadcast(spark):
    """The distinct members are within the broadcast threshold once measured, their copies are not: the copies are merged."""
    from yardstick.operators.dims import member_flag
    msgs = spark.range(5_000).select(F.concat(F.lit("C"), (F.col("id") % 997).cast("string")).alias("code"), "id")
    members = spark.range(200_000).select(F.concat(F.lit("C"), (F.col("id") % 500).cast("string")).alias("code"))
    settings = {"spark.sql.adaptive.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "100k"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        flagged = member_flag(msgs, "code", members, "m", salts=R.SALTS)
        got = flagged.collect()
        plan = flagged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == 5_000 and all(r.m == (r.id % 997 < 500) for r in got)
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_envelopes_parse_each_record_once(spark, monkeypatch):
    """The broker's time joins a record without another parse for each of its fields."""
    from pyspark.sql.readwriter import DataFrameWriter
    from yardstick.sources import files as FS
    written = []
    monkeypatch.setattr(DataFrameWriter, "json", lambda self, path: written.append(self._df))
    routed = spark.range(10).select(F.lit(TOPIC_VALIDATED).alias("topic"), F.format_string('{"record_id": "r%d"}', "id").alias("value"),
                                    F.lit(0).alias("partition"), F.col("id").alias("offset"), F.timestamp_seconds("id").alias("timestamp"))
    FS.write_batches(routed, "unused", "2024-01-31 00:00:00", REFERENCE)
    assert written[0]._jdf.queryExecution().optimizedPlan().toString().lower().count("from_json(") \
        + written[0]._jdf.queryExecution().optimizedPlan().toString().lower().count("jsontostructs(") == 1
    got = [(r.record_id, r.broker_micros) for r in written[0].select(F.inline("records")).select("record_id", "broker_micros").collect()]
    assert got == [(f"r{i}", i * 1_000_000) for i in range(10)]


def test_streams_read_members_as_a_table(spark):
    """Micro-batches scan the members' codes, they don't derive them again."""
    from tests.conftest import SF001
    from yardstick.params import DRIVER
    from yardstick.plans import catalog as K
    from yardstick.sources import panel
    members = K._members_table(spark, SF001)
    assert "Join" not in members._jdf.queryExecution().optimizedPlan().toString()
    assert rows(members) == rows(panel.members(spark, SF001, DRIVER).distinct())
