"""Property tests: exact rounding, upsert and priority union against plain definitions."""

from decimal import Decimal as D
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from yardstick.functions import columns as C
from yardstick.operators import combine as CB
from yardstick.operators.upsert import upsert

BIG = 10 ** 15


def half_away(fr: Fraction) -> int:
    q = int(abs(fr) + Fraction(1, 2))  # floor for non-negative
    return -q if fr < 0 else q


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-BIG, BIG), st.integers(-BIG, BIG).filter(lambda d: d != 0),
                          st.sampled_from([1, 100, 1000, 10000])), min_size=1, max_size=60))
def test_round_ratio_is_exact_half_away_from_zero(spark, cases):
    df = spark.createDataFrame(cases, "n long, d long, f int")
    got = []
    for f in sorted({c[2] for c in cases}):
        got += [(r.n, r.d, f, r.x) for r in df.filter(df.f == f).select("n", "d", C.round_ratio("n", "d", f).alias("x"))
                .collect()]
    assert sorted(got) == sorted((n, d, f, half_away(Fraction(n * f, d))) for n, d, f in cases)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, BIG), st.integers(1, 10 ** 6)), min_size=1, max_size=60))
def test_round_mean_is_exact_half_up(spark, cases):
    got = spark.createDataFrame(cases, "t long, n long").select("t", "n", C.round_mean("t", "n").alias("x")).collect()
    assert sorted((r.t, r.n, r.x) for r in got) == sorted((t, n, half_away(Fraction(t, n))) for t, n in cases)


def brute_upsert(current, incoming):
    """Dict-based definition: first arrival keeps 'name', last arrival gives 'value'."""
    table = {k: [name, value] for k, name, value in current}
    for k, name, value, _ in sorted(incoming, key=lambda r: r[3]):
        if k in table:
            table[k][1] = value
        else:
            table[k] = [name, value]
    return sorted((k, n, D(v).quantize(D("0.0001"))) for k, (n, v) in table.items())


keys = st.sampled_from(["a", "b", "c", "d"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(keys, st.text("xyz", max_size=2), st.integers(0, 99)), max_size=6,
                unique_by=lambda r: r[0]),
       st.lists(st.tuples(keys, st.text("xyz", max_size=2), st.integers(0, 99)), max_size=12))
def test_upsert_matches_definition(spark, current, incoming):
    current = [(k, n, D(v)) for k, n, v in current]
    inc = [(k, n, D(v), i) for i, (k, n, v) in enumerate(incoming)]
    cur_df = spark.createDataFrame(current, "k string, name string, value decimal(18,4)")
    inc_df = spark.createDataFrame(inc, "k string, name string, value decimal(18,4), seq int")
    out = upsert(cur_df, inc_df, ["k"], ["value"], ["seq"])
    assert rows(out) == brute_upsert(current, inc)


key_part = st.one_of(st.none(), st.sampled_from(["A", "B"]))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(key_part, key_part, st.sampled_from([1, 2]), st.integers(0, 9)), max_size=10),
       st.lists(st.tuples(key_part, key_part, st.sampled_from([1, 2]), st.integers(0, 9)), max_size=10))
def test_priority_union_matches_not_exists(spark, batch, stream):
    schema = "country_code string, indicator_code string, year int, value int"
    b = spark.createDataFrame(batch, schema)
    s = spark.createDataFrame(stream, schema)
    assert rows(CB.priority_union(b, s)) == rows(CB.anti_join_union(b, s))


def first_failure(r, p):
    """The validation rules as plain Python, in their fixed order (None when valid)."""
    for f in ("goal", "indicator_code", "country_code", "country_name", "year", "value"):
        if r[f] is None:
            return f"Missing required field: {f}"
    if not p.min_goal <= r["goal"] <= p.max_goal:
        return f"Invalid goal number: {r['goal']}"
    if not p.min_year <= r["year"] <= p.max_year:
        return f"Invalid year: {r['year']}"
    if r["value"] < 0 and r["indicator_code"] not in p.exempt_metrics:
        return f"Unexpected negative value: {float(r['value'])}"
    if len(r["country_code"]) != p.code_length:
        return f"Invalid country code: {r['country_code']}"
    return None


record = st.fixed_dictionaries({
    "goal": st.one_of(st.none(), st.integers(-2, 20)),
    "indicator_code": st.one_of(st.none(), st.sampled_from(["SI.POV.DDAY", "NY.GDP.MKTP.KD.ZG"])),
    "country_code": st.one_of(st.none(), st.sampled_from(["KEN", "KENYA", "", "NG"])),
    "country_name": st.one_of(st.none(), st.just("Kenya")),
    "year": st.one_of(st.none(), st.integers(1995, 2035)),
    "value": st.one_of(st.none(), st.sampled_from([-2.5, -1.0, 0.0, 3.25, 100.0])),
})


@settings(max_examples=5, deadline=None)
@given(st.lists(record, min_size=1, max_size=40))
def test_validation_matches_rule_list(spark, recs):
    from yardstick.operators.routing import validate
    from yardstick.params import REFERENCE as P
    schema = ("goal int, indicator_code string, country_code string, country_name string, year int, "
              "value double, i int")
    df = spark.createDataFrame([(r["goal"], r["indicator_code"], r["country_code"], r["country_name"], r["year"],
                                 r["value"], i) for i, r in enumerate(recs)], schema)
    got = {row.i: row.failure_reason for row in validate(df, P).select("i", "failure_reason").collect()}
    assert got == {i: first_failure(r, P) for i, r in enumerate(recs)}
