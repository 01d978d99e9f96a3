"""Staging, merge, change, gaps, scores and marts on hand-written rows (FIXTURES §3)."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from yardstick import schemas
from yardstick.operators import combine as CB
from yardstick.operators import marts as M
from yardstick.operators import progress as P
from yardstick.operators import staging as S
from yardstick.params import REFERENCE

TS = dt.datetime(2026, 3, 30, 12, 0, 0)


def batch_row(code="KEN", ind="SI.POV.DDAY", year=2020, value=D("10"), goal=1):
    return (ind, f" {ind} name ", goal, code, " Kenya ", year, value, None, None, "src", "2026-03-30T12:00:00+00:00Z", TS)


def stream_row(code="KEN", ind="SI.POV.DDAY", year=2020, value=D("10"), rid=None, goal=1):
    return (rid or f"{code}-{ind}-{year}", goal, ind, ind, code, "Kenya", year, value, None, None, "src",
            "2026-03-30T12:00:00Z", "2026-03-30T12:01:00Z", "batch.json", TS)


def goals_df(spark):
    return spark.createDataFrame([(1, " No poverty ", " End poverty ", 2030), (3, "Health", "Health", 2030)],
                                 schemas.RAW_GOALS)


def test_batch_staging_traps(spark):
    raw = spark.createDataFrame([
        batch_row(code=" ken "), batch_row(code=""), batch_row(code=None), batch_row(code="  "),
        batch_row(year=1999), batch_row(year=2000), batch_row(year=2030), batch_row(year=2031),
        batch_row(value=D("-1")), batch_row(ind="NY.GDP.MKTP.KD.ZG", value=D("-2.5")), batch_row(value=None),
    ], schemas.RAW_BATCH)
    out = S.stg_batch(raw, REFERENCE)
    got = rows(out, "country_code", "year", "value", "is_african_country", "sdg_milestone")
    assert got == sorted([
        ("KEN", 2020, D("10.0000"), False, "midpoint"),     # ' ken ' normalised, flag tested on raw code
        ("", 2020, D("10.0000"), False, "midpoint"),        # '  ' passes != '' and becomes ''
        ("KEN", 2000, D("10.0000"), True, "intermediate"),
        ("KEN", 2030, D("10.0000"), True, "target"),
        ("KEN", 2020, None, True, "midpoint"),              # negative -> NULL row kept
        ("KEN", 2020, D("-2.5000"), True, "midpoint"),      # exempt indicator keeps its sign
    ], key=repr)
    assert out.select("country_name", "indicator_name", "unit").first() == ("Kenya", "SI.POV.DDAY name", "")


def test_stream_staging_keeps_empty_code_and_latency(spark):
    raw = spark.createDataFrame([stream_row(code=""), stream_row(code=None), stream_row(year=2031)],
                                schemas.RAW_STREAM)
    out = S.stg_stream(raw, REFERENCE)
    r = out.collect()
    assert len(r) == 1 and r[0].country_code == "" and r[0].pipeline_latency_minutes == 0.0


def test_merge_batch_wins_and_stream_only_rows(spark):
    b = S.stg_batch(spark.createDataFrame([batch_row(value=D("-1"))], schemas.RAW_BATCH), REFERENCE)
    s = S.stg_stream(spark.createDataFrame(
        [stream_row(value=D("5")), stream_row(code="NGA", value=D("7"), goal=1)], schemas.RAW_STREAM), REFERENCE)
    g = S.stg_goals(goals_df(spark))
    c = CB.combine(b, s, g, REFERENCE)
    got = rows(c, "country_code", "value", "goal", "goal_title", "sdg_pillar", "is_african_country", "data_source")
    assert got == sorted([
        ("KEN", None, 1, "No poverty", "People", True, "batch"),       # NULL batch value still wins
        ("NGA", D("7.0000"), None, None, None, True, "streaming"),     # stream goal dropped to NULL
    ], key=repr)


def combined_df(spark, data):
    """(country, indicator, year, value, goal, member) -> combined schema rows."""
    out = [(ind, c, c + " name", g, "title" if g else None, "People" if g else None, ind + " name", y,
            None if v is None else D(str(v)), "", "", "src", "x", m, "intermediate", "batch")
           for c, ind, y, v, g, m in data]
    schema = ("indicator_code string, country_code string, country_name string, goal int, goal_title string, "
              "sdg_pillar string, indicator_name string, year int, value decimal(18,4), unit string, "
              "obs_status string, source string, extracted_at string, is_african_country boolean, "
              "sdg_milestone string, data_source string")
    return spark.createDataFrame(out, schema)


def test_year_over_year(spark):
    c = combined_df(spark, [
        ("A", "X", 2010, 0, 1, True), ("A", "X", 2011, 5, 1, True),           # zero predecessor
        ("B", "X", 2010, -4, 1, True), ("B", "X", 2011, -2, 1, True),         # negative predecessor
        ("C", "X", 2010, 10, 1, True), ("C", "X", 2013, 13, 1, True),         # 3-year gap
        ("D", "X", 2010, 3, 1, True), ("D", "X", 2011, None, 1, True),        # NULL value ignored
    ])
    got = rows(P.year_over_year(c), "country_code", "absolute_change", "pct_change", "years_elapsed",
               "annualised_pct_change")
    assert got == sorted([
        ("A", D("5.0000"), None, 1, None),
        ("B", D("2.0000"), D("50.00"), 1, D("50.00")),
        ("C", D("3.0000"), D("30.00"), 3, D("10.00")),
    ], key=repr)


def test_latest_per_definition_equals_aggregate(spark):
    c = combined_df(spark, [("A", "X", 2010, 1, 1, True), ("A", "X", 2012, 2, 1, True),
                            ("A", "Y", 2011, 3, 1, True), ("B", "X", 2009, 4, 1, True)])
    lp = P.latest_per(c.filter("value is not null"))
    g = P.target_gaps(c, P.targets_frame(spark, REFERENCE.with_(targets=())), REFERENCE)
    assert rows(lp, "country_code", "indicator_code", "year", "value") == \
        rows(g, "country_code", "indicator_code", "latest_year", "latest_value")


def scored_rows(spark, data, targets):
    c = combined_df(spark, data)
    p = REFERENCE.with_(targets=targets)
    return P.target_gaps(c, P.targets_frame(spark, p), p)


def test_gaps_statuses_and_scores(spark):
    targets = (("LOW", "25", "lower"), ("HIGH", "100", "higher"))
    data = [
        ("A", "LOW", 2015, 30, 1, True), ("A", "LOW", 2020, 25, 1, True),    # latest = target: achieved, 100
        ("B", "LOW", 2020, 40, 1, True),                                    # no baseline: off track, NULL
        ("C", "LOW", 2015, 20, 1, True), ("C", "LOW", 2020, 40, 1, True),    # baseline past target: 100
        ("D", "LOW", 2015, 60, 1, True), ("D", "LOW", 2020, 70, 1, True),    # worse than baseline: 0
        ("E", "HIGH", 2015, 40, 3, True), ("E", "HIGH", 2020, 55.5, 3, True),  # on track 25.8
        ("F", "NONE", 2020, 1, 3, True),                                    # no target
        ("G", "LOW", 2015, 60, 1, False), ("G", "LOW", 2020, 50, 1, False),  # not a member: not scored
    ]
    g = scored_rows(spark, data, targets)
    st = dict((r[0], r[1]) for r in g.select("country_code", "target_status").collect())
    assert st == {"A": "achieved", "B": "off track", "C": "off track", "D": "off track", "E": "on track",
                  "F": "no target defined", "G": "on track"}
    sc = dict((r[0], r[1]) for r in P.scored(g).select("country_code", "score_tenths").collect())
    assert sc == {"A": 1000, "B": None, "C": 1000, "D": 0, "E": 258}
    s = P.scores(g)
    got = rows(s, "country_code", "goal", "indicators_tracked", "avg_goal_score", "indicators_achieved",
               "indicators_on_track", "indicators_off_track")
    assert got == sorted([
        ("A", 1, 1, D("100.0"), 1, 0, 0), ("C", 1, 1, D("100.0"), 0, 0, 1), ("D", 1, 1, D("0.0"), 0, 0, 1),
        ("E", 3, 1, D("25.8"), 0, 1, 0),
    ], key=repr)


def scores_df(spark, data):
    schema = ("country_code string, country_name string, goal int, goal_title string, sdg_pillar string, "
              "indicators_tracked long, avg_goal_score decimal(5,1), indicators_achieved long, "
              "indicators_on_track long, indicators_off_track long, data_as_of int")
    return spark.createDataFrame([(c, c, g, None, None, 1, D(s), 0, 0, 0, 2020) for c, g, s in data], schema)


def dims_df(spark, codes):
    schema = ("country_code string, country_name string, region string, income_group string, income_tier int, "
              "continent string, is_african boolean, overall_sdg_score decimal(5,1), total_indicators_achieved long, "
              "total_indicators_on_track long, total_indicators_off_track long, data_as_of int")
    return spark.createDataFrame([(c, c, "R", "I", 1, "Africa", True, None, 0, 0, 0, 2020) for c in codes], schema)


def test_peer_rank_ties_and_average_match_window_definition(spark):
    data = [("KEN", 1, "50.0"), ("TZA", 1, "70.0"), ("UGA", 1, "70.0"), ("RWA", 1, "10.0"),
            ("ETH", None, "33.3"), ("SSD", None, "66.7"), ("NGA", 1, "99.0")]
    s = scores_df(spark, data)
    d = dims_df(spark, [c for c, _, _ in data])
    got = M.peer_comparison(s, d, ["KEN", "TZA", "UGA", "RWA", "ETH", "SSD"], REFERENCE)
    ranks = dict((r[0], (r[1], r[2])) for r in got.select("country_code", "ea_rank", "vs_ea_average").collect())
    # brute force with the window definition
    peers = s.filter(F.col("country_code").isin("KEN", "TZA", "UGA", "RWA", "ETH", "SSD"))
    w = Window.partitionBy("goal")
    bf = peers.select("country_code", F.rank().over(w.orderBy(F.desc_nulls_first("avg_goal_score"))).alias("r"),
                      F.round(F.col("avg_goal_score") - F.avg("avg_goal_score").over(w), 1).alias("v"))
    for r in bf.collect():
        assert ranks[r.country_code][0] == r.r
        assert ranks[r.country_code][1] == r.v
    assert ranks["TZA"][0] == ranks["UGA"][0] == 1 and ranks["KEN"][0] == 3  # equal rank, next skipped


def test_goal_summary_status_uses_unrounded_average(spark):
    s = scores_df(spark, [("A", 1, "75.0"), ("B", 1, "74.9"), ("C", 2, "50.0"), ("D", 3, "25.0"), ("E", 4, "24.9")])
    got = dict((r[0], (r[1], r[2])) for r in M.goal_summary(s).select("goal", "africa_avg_score", "goal_status")
               .collect())
    assert got[1] == (D("75.0"), "Moderate progress")   # 74.95 rounds to 75.0 but status uses 74.95
    assert got[2][1] == "Moderate progress" and got[3][1] == "Limited progress" and got[4][1] == "Off track"


def test_best_worst_ties_prefer_lowest_goal(spark):
    sm = spark.createDataFrame([(1, "a", D("50.0")), (2, "b", D("50.0")), (None, None, D("50.0")), (3, "c", D("10.0"))],
                               "goal int, goal_title string, africa_avg_score decimal(5,1)")
    got = dict((r[0], r[1]) for r in M.best_worst_goal(sm).select("position", "goal").collect())
    assert got == {"best": 1, "worst": 3}


@pytest.mark.parametrize("score,label", [("75.0", "On track"), ("50.0", "Moderate progress"),
                                          ("25.0", "Limited progress"), ("24.9", "Off track")])
def test_tracker_classes(spark, score, label):
    s = scores_df(spark, [("A", 1, score)])
    t = M.tracker(s, dims_df(spark, ["A"]), REFERENCE)
    r = t.first()
    assert r.progress_category == label and r.years_remaining == 10 and r.region == "R"


def test_priority_union_equals_anti_join_definition(spark):
    schema = "country_code string, indicator_code string, year int, value int, src string"
    b = spark.createDataFrame([("A", "X", 1, None, "b"), ("A", None, 1, 1, "b"), ("B", "X", 2, 2, "b"),
                               ("B", "X", 2, 3, "b")], schema)
    s = spark.createDataFrame([("A", "X", 1, 9, "s"), ("A", None, 1, 9, "s"), ("C", "X", 1, 9, "s"),
                               ("B", "X", 2, 9, "s"), (None, "X", 2, 9, "s")], schema)
    assert rows(CB.priority_union(b, s)) == rows(CB.anti_join_union(b, s))
    assert len(rows(CB.priority_union(b, s))) == 7  # 4 batch + (A,NULL,1), C, NULL-code stream rows
