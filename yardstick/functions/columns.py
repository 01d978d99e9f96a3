"""Column expressions: the scalar operators and domain classifiers.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from yardstick.params import PILLARS, PROGRESS_CLASSES, PROGRESS_FLOOR_LABEL, PanelParams

VALUE_TYPE = "decimal(24,4)"  # |value| < 1e20
CHANGE_TYPE = "decimal(26,4)"  # the difference of two values always fits
WIDE_INT = "decimal(38,0)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- B2/B3/B6/B25: text cleaning ------------------------------------------

def clean_text(c) -> Column:
    return F.trim(col(c))


def clean_code(c) -> Column:
    """upper(trim(code))"""
    return F.upper(F.trim(col(c)))


def default_empty(c) -> Column:
    return F.coalesce(col(c), F.lit(""))


def field_or(struct_field, default) -> Column:
    """Nested field with a default."""
    return F.coalesce(col(struct_field), F.lit(default))


# ---- B4/B5/B30: numeric -----------------------------------------------------

def to_value(c) -> Column:
    """Cast an observation value to the engine's decimal, rounded to 4 places.

    A value that is not a number below 1e20 becomes NULL (under any ANSI setting); it never stops a
    job. Validation sends such a record to dead letter (see ``out_of_range``).
    """
    return F.round(col(c).try_cast("decimal(38,10)"), 4).try_cast(VALUE_TYPE)


def out_of_range(c) -> Column:
    """Whether a value is given that the engine's decimal can't hold (1e20 or more in size, or not finite)."""
    return col(c).isNotNull() & to_value(c).isNull()


def change(new, old) -> Column:
    """new - old of two values; NULL where either is."""
    return (col(new) - col(old)).cast(CHANGE_TYPE)


def clean_value(value, metric, exempt: Iterable[str]) -> Column:
    """Negative -> NULL unless the metric is exempt; else round to 4 places.

    NULL metric behaves as in SQL: the negative test is unknown, so the value
    is kept.
    """
    v, m = col(value), col(metric)
    exempt = list(exempt)
    neg_forbidden = (v < 0) & ~m.isin(*exempt) if exempt else (v < 0)
    return F.when(v.isNull(), F.lit(None).cast(VALUE_TYPE)).when(
        neg_forbidden, F.lit(None).cast(VALUE_TYPE)
    ).otherwise(to_value(v))


def scaled(c, places: int = 4) -> Column:
    """A decimal with ``places`` digits as an exact integer count of 10^-places."""
    return (col(c) * F.lit(10 ** places)).cast(WIDE_INT)


def _floor_div(x: Column, y: Column) -> Column:
    """floor(x / y) for x >= 0, y > 0, exact on wide integers."""
    return ((x - F.pmod(x, y)) / y).cast(WIDE_INT)


def round_ratio(num, den, factor: int) -> Column:
    """round(num * factor / den) to an integer, half away from zero, exact.

    ``num`` and ``den`` are integral columns (see ``scaled``); NULL when either
    is NULL or den is 0. Engines disagree on decimal-division scale and double
    ties, so rates and scores are held as integer units (tenths, hundredths)
    computed with this one rule. The result is a wide integer: for observation
    values (|value| < 1e20) and factors up to 10000 nothing in it overflows.
    """
    n, d = col(num).cast(WIDE_INT), col(den).cast(WIDE_INT)
    q = _floor_div(F.abs(n) * 2 * factor + F.abs(d), F.abs(d) * 2)
    neg = ((n < 0) & (d > 0)) | ((n > 0) & (d < 0))
    return F.when(d == 0, F.lit(None).cast(WIDE_INT)).otherwise(F.when(neg, -q).otherwise(q))


def round_mean(total, count) -> Column:
    """round(total / count) half up, for a non-negative integral total."""
    t, n = col(total).cast(WIDE_INT), col(count).cast(WIDE_INT)
    return F.when(n == 0, F.lit(None).cast(WIDE_INT)).otherwise(_floor_div(t * 2 + n, n * 2))


def units_to_decimal(units, scale: int, precision: int = 18) -> Column:
    """Integer count of 10^-scale -> decimal(precision, scale)."""
    return (col(units).cast(WIDE_INT) / F.lit(10 ** scale)).cast(f"decimal({precision},{scale})")


def clamp(c, lo, hi) -> Column:
    """greatest(lo, least(hi, c)) (B9); NULL-ignoring like SQL."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), col(c)))


# ---- B13/B14/B32: membership and ranges --------------------------------------

def is_member(code, members: Iterable[str]) -> Column:
    """Member flag on the raw (untrimmed) code; never NULL."""
    return F.coalesce(col(code).isin(*list(members)), F.lit(False))


def in_range(c, lo, hi) -> Column:
    return col(c).between(lo, hi)


# ---- B31/B33/B34: classifiers --------------------------------------------------

def milestone(year, p: PanelParams, with_target: bool = True) -> Column:
    y = col(year)
    e = F.when(y == p.baseline_year, "baseline").when(y == p.midpoint_year, "midpoint")
    if with_target:
        e = e.when(y == p.horizon_year, "target")
    return e.otherwise("intermediate")


def pillar(goal) -> Column:
    g = col(goal)
    e = None
    for (lo, hi), name in PILLARS:
        cond = g.between(lo, hi)
        e = F.when(cond, name) if e is None else e.when(cond, name)
    return e.otherwise("Unknown")


def income_tier(group, tiers) -> Column:
    g = col(group)
    e = None
    for name, tier in tiers:
        e = F.when(g == name, tier) if e is None else e.when(g == name, tier)
    return e.otherwise(0) if e is not None else F.lit(0)


def progress_category(score_tenths) -> Column:
    """Thresholds 75/50/25 on a score held in tenths; NULL -> floor label."""
    s = col(score_tenths)
    e = None
    for lo, label in PROGRESS_CLASSES:
        e = F.when(s >= lo * 10, label) if e is None else e.when(s >= lo * 10, label)
    return e.otherwise(PROGRESS_FLOOR_LABEL)


# ---- B35/B37: target status and progress score ----------------------------------

def target_status(latest, baseline, target, direction) -> Column:
    """Ordered rule: no target -> achieved -> on track (needs baseline) -> off track."""
    l, b, t, d = col(latest), col(baseline), col(target), col(direction)
    return (
        F.when(t.isNull(), "no target defined")
        .when((d == "lower") & (l <= t), "achieved")
        .when((d == "higher") & (l >= t), "achieved")
        .when((d == "lower") & (l < b), "on track")
        .when((d == "higher") & (l > b), "on track")
        .otherwise("off track")
    )


def progress_score_tenths(status, latest, baseline, target, direction) -> Column:
    """0-100 progress score in integer tenths.

    achieved -> 1000 before the NULL-baseline test; baseline already past the
    target -> 1000; no progress from the baseline -> 0, target reached -> 1000 (by
    comparison, so an outlier needs no division); in between round(1000 * progress / needed).
    """
    s, l, b, t, d = col(status), col(latest), col(baseline), col(target), col(direction)
    L, B, T = scaled(l), scaled(b), scaled(t)
    none, full, zero = F.lit(None).cast("long"), F.lit(1000).cast("long"), F.lit(0).cast("long")
    lower = round_ratio(B - L, B - T, 1000).cast("long")
    higher = round_ratio(L - B, T - B, 1000).cast("long")
    return (
        F.when(s == "achieved", full)
        .when(b.isNull(), none)
        .when(d == "lower", F.when((b <= t) | (l <= t), full).when(l >= b, zero).otherwise(lower))
        .when(d == "higher", F.when((b >= t) | (l >= t), full).when(l <= b, zero).otherwise(higher))
        .otherwise(none)
    )


# ---- B17-B23: time, identity, text ------------------------------------------------

def parse_iso(c) -> Column:
    """Offset-safe ISO-8601 parse: accepts '...Z', '...+00:00' and the malformed
    '...+00:00Z'; anything else -> NULL (B19)."""
    fixed = F.regexp_replace(col(c), r"([+-]\d\d:\d\d)Z$", "$1")
    return fixed.try_cast("timestamp")


def utc_wall(c) -> Column:
    """An instant (TIMESTAMP) as its UTC wall-clock time (TIMESTAMP_NTZ), whatever the session time zone.

    Naive timestamps in this model are UTC wall-clock times; comparing or
    subtracting in that form keeps results independent of the session zone.
    """
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), col(c).cast("timestamp_ntz"))


def as_utc_wall(c, dtype) -> Column:
    """``c`` as UTC wall-clock TIMESTAMP_NTZ given its type (naive values are taken as UTC already)."""
    return col(c) if isinstance(dtype, TimestampNTZType) else utc_wall(c)


def parse_iso_utc(c) -> Column:
    """``parse_iso`` as UTC wall-clock TIMESTAMP_NTZ."""
    return utc_wall(parse_iso(c))


def minutes_between(end, start) -> Column:
    """(end - start) in minutes as double (B17); both UTC wall-clock TIMESTAMP_NTZ."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)).cast("double") / F.lit(60000000.0)


def within_days(ts, days: int, as_of: str) -> Column:
    """ts > as_of - days (B18) on UTC wall-clock times; ``as_of`` is passed in, so results are reproducible."""
    return col(ts) > (F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS"))


def date_path(ts) -> Column:
    """UTC 'yyyy/MM/dd' (B20)."""
    return F.date_format(col(ts), "yyyy/MM/dd")


def stamp(ts) -> Column:
    """UTC 'yyyyMMdd_HHmmss' (B20)."""
    return F.date_format(col(ts), "yyyyMMdd_HHmmss")


def record_id(entity, metric, year) -> Column:
    """md5 of 'entity_metric_year' (H3). NULL parts are rendered 'None' as the
    producer's string formatting does, instead of being skipped by concat_ws."""
    parts = [F.coalesce(col(c).cast("string"), F.lit("None")) for c in (entity, metric, year)]
    return F.md5(F.concat_ws("_", *parts))


def slug(code) -> Column:
    """'.' -> '_' (B23)."""
    return F.translate(col(code), ".", "_")


def years_left(year, horizon: int) -> Column:
    return F.lit(horizon) - col(year)
