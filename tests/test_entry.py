"""Driver contract: entry() and the query registry."""

import __spark_entry__ as E
from tests.conftest import SF001


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    out = df.collect()
    assert len(out) > 0
    assert df.columns[:3] == ["goal", "goal_title", "sdg_pillar"]


def test_every_oracle_has_a_query_and_columns_are_named():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 40


def test_all_queries_run_on_smoke_data(spark):
    for name, fn in E.queries().items():
        df = fn(spark, SF001)
        assert all(not c.startswith("__") for c in df.columns), name
        df.limit(5).collect()
