"""End to end with the reference workload's own parameters (lists for members and peers)."""

import datetime as dt
from decimal import Decimal as D

from tests.conftest import rows
from yardstick import schemas
from yardstick.operators import combine as CB
from yardstick.operators import marts as M
from yardstick.operators import progress as P
from yardstick.operators import staging as S
from yardstick.params import REFERENCE, SDG_INDICATORS

TS = dt.datetime(2026, 3, 30, 12, 0, 0)
NAMES = {c: n for c, _, n in SDG_INDICATORS}
GOALS = {c: g for c, g, _ in SDG_INDICATORS}


def b(code, ind, year, value):
    return (ind, NAMES[ind], GOALS[ind], code, code.title(), year, D(str(value)), "%", "", "src",
            "2026-03-30T12:00:00+00:00Z", TS)


def s(code, ind, year, value):
    return (f"{code}_{ind}_{year}", GOALS[ind], ind, NAMES[ind], code, code.title(), year, D(str(value)), None, None,
            "src", "2026-03-30T12:00:00Z", "2026-03-30T12:00:05Z", "batch.json", TS)


def test_reference_chain(spark):
    raw_b = spark.createDataFrame([
        b("KEN", "SH.DYN.MORT", 2015, 50), b("KEN", "SH.DYN.MORT", 2020, 40),      # on track, 40.0
        b("TZA", "SH.DYN.MORT", 2015, 60), b("TZA", "SH.DYN.MORT", 2021, 20),      # achieved, 100
        b("NGA", "SE.PRM.ENRR", 2015, 80), b("NGA", "SE.PRM.ENRR", 2020, 90),      # on track, 50.0
        b("UGA", "SE.PRM.ENRR", 2015, 70), b("UGA", "SE.PRM.ENRR", 2020, 40),      # off track, 0
        b("FRA", "SH.DYN.MORT", 2015, 5), b("FRA", "SH.DYN.MORT", 2020, 4),        # not a member
        b("KEN", "SP.DYN.LE00.IN", 2015, 60), b("KEN", "SP.DYN.LE00.IN", 2020, 62),  # no target
    ], schemas.RAW_BATCH)
    raw_s = spark.createDataFrame([
        s("UGA", "SE.PRM.ENRR", 2022, 85),   # newer stream year: latest, NULL goal, 50.0
        s("KEN", "SH.DYN.MORT", 2020, 1),    # same key as batch: batch wins
    ], schemas.RAW_STREAM)
    raw_g = spark.createDataFrame([(g, f"Goal {g}", f"Goal {g} text", 2030) for g in range(1, 18)],
                                  schemas.RAW_GOALS)
    raw_c = spark.createDataFrame([(c, c.title(), "Sub-Saharan Africa", "Low income", "Africa", True)
                                   for c in ("KEN", "TZA", "NGA", "UGA")] +
                                  [("FRA", "France", "Europe", "High income", "Europe", False)], schemas.RAW_COUNTRIES)

    p = REFERENCE
    combined = CB.combine(S.stg_batch(raw_b, p), S.stg_stream(raw_s, p), S.stg_goals(raw_g), p)
    assert combined.count() == 13
    gaps = P.target_gaps(combined, P.targets_frame(spark, p), p)
    scores = P.scores(gaps)
    got = rows(scores, "country_code", "goal", "goal_title", "avg_goal_score", "indicators_achieved",
               "indicators_on_track", "indicators_off_track", "data_as_of")
    assert got == sorted([
        ("KEN", 3, "Goal 3", D("40.0"), 0, 1, 0, 2020),
        ("TZA", 3, "Goal 3", D("100.0"), 1, 0, 0, 2021),
        ("NGA", 4, "Goal 4", D("50.0"), 0, 1, 0, 2020),
        ("UGA", None, None, D("50.0"), 0, 1, 0, 2022),   # left goal 4 for the NULL-goal group
    ], key=repr)

    countries = S.stg_countries(raw_c, p)
    dims = M.dim_countries(countries, scores)
    assert dict((r[0], r[1]) for r in dims.select("country_code", "overall_sdg_score").collect()) == {
        "KEN": D("40.0"), "TZA": D("100.0"), "NGA": D("50.0"), "UGA": D("50.0"), "FRA": None}
    assert dims.filter("country_code = 'KEN'").first().income_tier == 1

    tr = dict((r[0], (r[1], r[2])) for r in M.tracker(scores, dims, p)
              .select("country_code", "progress_category", "years_remaining").collect())
    assert tr == {"KEN": ("Limited progress", 10), "TZA": ("On track", 9), "NGA": ("Moderate progress", 10),
                  "UGA": ("Moderate progress", 8)}

    peer = M.peer_comparison(scores, countries, p.peers, p)
    assert rows(peer, "country_code", "goal", "ea_rank", "vs_ea_average") == sorted([
        ("KEN", 3, 2, D("-30.0")), ("TZA", 3, 1, D("30.0")), ("UGA", None, 1, D("0.0"))], key=repr)

    summary = {r[0]: (r[1], r[2]) for r in M.goal_summary(scores).select("goal", "countries_tracked", "goal_status")
               .collect()}
    assert summary == {3: (2, "Moderate progress"), 4: (1, "Moderate progress"), None: (1, "Moderate progress")}
