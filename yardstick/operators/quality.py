"""Data-quality checks: pre-transform gate (I4-I9) and column tests.

Every check is an aggregate; all checks on one table run in one pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardstick.functions import columns as C
from yardstick.params import PanelParams


class GateFailed(ValueError):
    pass


def _rows(df: DataFrame, rows: Sequence[tuple[str, F.Column, F.Column]]) -> DataFrame:
    """Turn a one-row aggregate into (check, observed, passed) rows."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("check_name"), obs.cast("long").alias("observed"), ok.alias("passed"))
        for n, obs, ok in rows
    ])))


def gate_report(raw_batch: DataFrame, raw_stream: DataFrame, p: PanelParams, as_of: str) -> DataFrame:
    """The five gate checks (I4-I8) as rows (check, observed, passed)."""
    b = raw_batch.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("country_code").isNull() | (F.col("country_code") == "")).alias("bad_codes"),
        F.count_if((F.col("year") < p.min_year) | (F.col("year") > p.max_year)).alias("bad_years"),
        F.count_if((F.col("value") < 0) & ~F.col("indicator_code").isin(*p.exempt_metrics)).alias("negatives"),
    )
    s = raw_stream.agg(F.count_if(C.within_days(C.parse_iso_utc("extracted_at"), p.gate_recent_days, as_of))
                       .alias("recent"))
    batch_rows = _rows(b, [
        ("min_rows", F.col("n"), F.col("n") >= p.gate_min_rows),
        ("no_null_codes", F.col("bad_codes"), F.col("bad_codes") == 0),
        ("year_range", F.col("bad_years"), F.col("bad_years") == 0),
        ("no_unexpected_negatives", F.col("negatives"), F.col("negatives") == 0),
    ])
    stream_rows = _rows(s, [("recent_stream_rows", F.col("recent"), F.col("recent") > 0)])
    return batch_rows.unionByName(stream_rows)


def gate_verdict(report: DataFrame) -> DataFrame:
    """I9 as a relation, one row: checks passed and failed, the failed names, and whether to stop."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check_name"))))
    return report.agg(
        F.count_if("passed").alias("checks_passed"), F.count_if(~F.col("passed")).alias("checks_failed"),
        F.array_join(failed, ",").alias("failed_checks"), (F.count_if(~F.col("passed")) > 0).alias("stop"))


def gate(report) -> dict:
    """Raise when any check failed. ``report``: the relation or its five collected rows."""
    rows = report.collect() if isinstance(report, DataFrame) else report
    failed = [f"{r['check_name']} (observed {r['observed']})" for r in rows if not r["passed"]]
    if failed:
        raise GateFailed(f"Data quality checks failed: {failed}")
    return {"passed": len(rows), "failed": 0}


# (model, not_null columns, unique columns)
COLUMN_TESTS = (
    ("raw_batch", ("indicator_code", "country_code", "year"), ()),
    ("raw_stream", ("record_id",), ("record_id",)),
    ("raw_goals", ("goal",), ("goal",)),
    ("raw_countries", ("country_code",), ("country_code",)),
    ("stg_batch", ("indicator_code", "country_code", "year", "value", "is_african_country"), ()),
    ("stg_stream", ("record_id",), ("record_id",)),
    ("stg_goals", ("goal",), ("goal",)),
    ("stg_countries", ("country_code",), ("country_code",)),
    ("fct_progress", ("country_code", "indicator_code", "year", "value"), ()),
    ("dim_countries", ("country_code",), ("country_code",)),
    ("dim_goals", ("goal",), ("goal",)),
)


def model_tests(df: DataFrame, not_null: Iterable[str], unique: Iterable[str], model: str) -> DataFrame:
    """I10 and I11 of one model as rows (model, column_name, test, failures), in one pass.

    not_null counts NULLs; unique counts non-NULL values that occur more than once. With a unique
    column the rows are grouped by it and the groups carry the NULL counts.
    """
    not_null, unique = list(not_null), list(unique)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"__nn{i}") for i, c in enumerate(not_null)]
    if len(unique) > 1:
        raise ValueError("one unique column per model")
    if unique:
        key = F.col(unique[0])
        per = df.groupBy(key.alias("__key")).agg(F.count(F.lit(1)).alias("__n"), *nulls)
        a = per.agg(F.count_if(F.col("__key").isNotNull() & (F.col("__n") > 1)).alias("__uq"),
                    *[F.coalesce(F.sum(f"__nn{i}"), F.lit(0)).alias(f"__nn{i}") for i in range(len(not_null))])
    else:
        a = df.agg(*nulls)
    row = lambda c, test, n: F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                                      F.lit(test).alias("test"), F.col(n).alias("failures"))
    return a.select(F.inline(F.array(*[row(c, "not_null", f"__nn{i}") for i, c in enumerate(not_null)],
                                     *[row(c, "unique", "__uq") for c in unique])))


def column_tests(models: dict[str, DataFrame], tests=COLUMN_TESTS) -> DataFrame:
    """All 28 column tests as rows (model, column_name, test, failures)."""
    out = None
    for model, nn, uq in tests:
        part = model_tests(models[model], nn, uq, model)
        out = part if out is None else out.unionByName(part)
    return out
