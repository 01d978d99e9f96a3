"""Scalar operators and classifiers (B-family) on hand-written rows."""

import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from yardstick.functions import columns as C
from yardstick.params import REFERENCE


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_clean_value_negative_and_exempt(spark):
    data = [(Decimal("-1.5"), "SI.POV.DDAY"), (Decimal("-1.5"), "NY.GDP.MKTP.KD.ZG"),
            (Decimal("2.123456"), "X"), (None, "X"), (Decimal("-3"), None)]
    got = one(spark, C.clean_value("v", "m", REFERENCE.exempt_metrics), data, "v decimal(18,6), m string")
    assert got == [None, Decimal("-1.5000"), Decimal("2.1235"), None, Decimal("-3.0000")]


def test_parse_iso_forms(spark):
    data = [("2026-03-30T12:15:00.123456+00:00Z",), ("2026-03-30T12:15:00Z",), ("garbage",), (None,)]
    got = spark.createDataFrame(data, "s string").select(
        F.date_format(C.parse_iso("s"), "yyyy-MM-dd HH:mm:ss").alias("x")).collect()
    assert [r.x for r in got] == ["2026-03-30 12:15:00", "2026-03-30 12:15:00", None, None]


def test_record_id_matches_md5_of_delimited_key(spark):
    got = one(spark, C.record_id("c", "i", "y"), [("KEN", "SP.DYN.LE00.IN", 2015)], "c string, i string, y int")
    assert got == [hashlib.md5(b"KEN_SP.DYN.LE00.IN_2015").hexdigest()]


def test_round_ratio_half_away_from_zero(spark):
    data = [(1, 2), (-1, 2), (3, 2), (-3, 2), (1, 3), (2, 3), (5, 0), (None, 2), (1, -2)]
    got = one(spark, C.round_ratio("n", "d", 1), data, "n long, d long")
    assert got == [1, -1, 2, -2, 0, 1, None, None, -1]


def test_round_mean_half_up(spark):
    got = one(spark, C.round_mean("t", "n"), [(5, 2), (4, 3), (7, 2), (0, 0)], "t long, n long")
    assert got == [3, 1, 4, None]


def test_milestone_and_pillar(spark):
    got = one(spark, C.milestone("y", REFERENCE), [(2015,), (2020,), (2030,), (2010,)], "y int")
    assert got == ["baseline", "midpoint", "target", "intermediate"]
    got = one(spark, C.milestone("y", REFERENCE, with_target=False), [(2030,)], "y int")
    assert got == ["intermediate"]
    got = one(spark, C.pillar("g"), [(1,), (6,), (13,), (17,), (18,), (None,)], "g int")
    assert got == ["People", "Prosperity", "Planet", "Peace & Partnership", "Unknown", "Unknown"]


def test_income_tier(spark):
    got = one(spark, C.income_tier("g", REFERENCE.income_tiers),
              [("Low income",), ("High income",), (" High income",), (None,)], "g string")
    assert got == [1, 4, 0, 0]


def test_progress_category_boundaries(spark):
    got = one(spark, C.progress_category("t"), [(750,), (749,), (500,), (250,), (249,), (None,)], "t long")
    assert got == ["On track", "Moderate progress", "Moderate progress", "Limited progress", "Off track",
                   "Off track"]


def test_target_status_order(spark):
    schema = "l decimal(18,4), b decimal(18,4), t decimal(18,4), d string"
    data = [
        (Decimal(5), Decimal(9), None, None),           # no target
        (Decimal(25), Decimal(90), Decimal(25), "lower"),   # equal -> achieved
        (Decimal(50), None, Decimal(50), "higher"),     # equal -> achieved, no baseline needed
        (Decimal(40), Decimal(60), Decimal(25), "lower"),   # on track
        (Decimal(40), None, Decimal(25), "lower"),       # no baseline -> off track
        (Decimal(60), Decimal(60), Decimal(25), "lower"),   # equal to baseline -> off track
    ]
    got = one(spark, C.target_status("l", "b", "t", "d"), data, schema)
    assert got == ["no target defined", "achieved", "achieved", "on track", "off track", "off track"]


def test_progress_score_cases(spark):
    schema = "s string, l decimal(18,4), b decimal(18,4), t decimal(18,4), d string"
    data = [
        ("achieved", Decimal(20), None, Decimal(25), "lower"),      # achieved before NULL-baseline test
        ("off track", Decimal(40), None, Decimal(25), "lower"),     # no baseline -> NULL
        ("off track", Decimal(40), Decimal(20), Decimal(25), "lower"),  # baseline past target -> 100
        ("off track", Decimal(70), Decimal(60), Decimal(25), "lower"),  # worse than baseline -> 0
        ("on track", Decimal(50), Decimal(60), Decimal(25), "lower"),   # 10/35 = 28.57 -> 28.6
        ("on track", Decimal("55.5"), Decimal(40), Decimal(100), "higher"),  # 15.5/60 = 25.83 -> 25.8
        ("off track", Decimal(1), Decimal(2), Decimal(0), "sideways"),  # unknown direction -> NULL
    ]
    got = one(spark, C.progress_score_tenths("s", "l", "b", "t", "d"), data, schema)
    assert got == [1000, None, 1000, 0, 286, 258, None]


def test_minutes_between_and_within_days(spark):
    df = spark.createDataFrame([("2026-03-30T12:00:00Z", "2026-03-30 12:30:00")], "e string, c string")
    r = df.select(C.minutes_between(F.col("c").cast("timestamp_ntz"), C.parse_iso_utc("e")).alias("m"),
                  C.within_days(C.parse_iso_utc("e"), 7, "2026-04-05 00:00:00").alias("w1"),
                  C.within_days(C.parse_iso_utc("e"), 7, "2026-04-07 00:00:00").alias("w2")).first()
    assert r.m == 30.0 and r.w1 is True and r.w2 is False


def test_time_functions_do_not_depend_on_session_zone(spark):
    df = spark.createDataFrame([("2026-03-30T23:30:00Z", "2026-03-31 00:15:00")], "e string, c string")
    out = []
    for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        try:
            r = df.select(C.minutes_between(F.col("c").cast("timestamp_ntz"), C.parse_iso_utc("e")).alias("m"),
                          F.date_format(C.parse_iso_utc("e"), "yyyy-MM-dd HH:mm").alias("d"),
                          C.within_days(C.parse_iso_utc("e"), 1, "2026-03-31 23:00:00").alias("w")).first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        out.append(tuple(r))
    assert out == [(45.0, "2026-03-30 23:30", True)] * 3


def test_slug_and_date_path(spark):
    df = spark.createDataFrame([("SI.POV.DDAY", "2026-03-30 12:15:00")], "c string, t string")
    r = df.select(C.slug("c").alias("s"), C.date_path(F.col("t").cast("timestamp")).alias("p"),
                  C.stamp(F.col("t").cast("timestamp")).alias("k")).first()
    assert (r.s, r.p, r.k) == ("SI_POV_DDAY", "2026/03/30", "20260330_121500")
