"""Whitening against whole-table NumPy, and on odd vectors."""

import math

import numpy as np
import pytest

from tests.llm.conftest import SF
from yardstick.llm import whitening as W
from yardstick.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def valid(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def xs(v):
    return tuple(math.floor(64 * float(c)) + 1_000_000 for c in v)


def check(rows, got, weights="one", tolerance=1e-7):
    """Everything but the sign of a component, from all rows at once."""
    by_id = {}
    for r in got:
        by_id.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    lists = {}
    for _, v in rows:
        if valid(v) and len(v):
            lists.setdefault(len(v), []).append(xs(v))
    assert len(got) == sum(min(d, 16) * len(v) for d, v in lists.items())
    for d, every in lists.items():
        fit = sorted(set(every)) if weights == "one" else sorted(every)
        n = len(fit)
        sums = [sum(x[j] for x in fit) for j in range(d)]
        c = np.array([[float(n * x[j] - sums[j]) / n for j in range(d)] for x in fit])
        cov = c.T @ c / n
        e = np.sort(np.linalg.eigvalsh(cov))[::-1][:16]
        white, seen = {}, {}
        for i, v in rows:
            if not valid(v) or len(v) != d:
                continue
            x = xs(v)
            dev = sum((n * x[j] - sums[j]) ** 2 for j in range(d))
            mine = [p[0] for _, p in sorted(by_id[i, dev].items())]
            assert [r.component for r in mine] == list(range(1, min(16, d) + 1))
            assert all(r.n == n for r in mine)
            white[x] = [r.whitened for r in mine]
            seen[x] = seen.get(x, 0) + 1
            for r, k in zip(mine, e, strict=True):
                if np.trace(cov) > 0:
                    assert abs(r.explained - max(k, 0) / np.trace(cov)) <= 1e-9
        m = np.array([white[x] for x in fit], dtype=float)
        real = ~np.isnan(m).any(0)
        assert (real == (e > e[0] * 1e-9)).all() if e[0] > 0 else not real.any()
        w = m[:, real] - m[:, real].mean(0)
        if real.any():
            assert np.abs(w.T @ w / n - np.eye(real.sum())).max() <= 1e-6
            assert all(r.identity_error <= 1e-4 for r in got if r.n == n and r.identity_error is not None)
            # every component is an eigenvector of its eigenvalue: V times the regression of x on it gives it back
            axes = np.linalg.lstsq(c, m[:, real] * np.sqrt(e[real]), rcond=None)[0] if n > d else None
            if axes is not None and np.linalg.matrix_rank(c) == d:
                assert np.abs(cov @ axes - axes * e[real]).max() <= tolerance * e[0]
                assert np.abs(np.linalg.norm(axes, axis=0) - 1).max() <= tolerance


def test_query_against_numpy(spark):
    got = W.op11_multiplicity_whitening(spark, SF)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                "explained": "double", "identity_error": "double"}
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    check(rows, got.collect())


@pytest.mark.parametrize("weights", ["one", "counts"])
def test_copies_and_small_dimensions(spark, weights):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 5)).astype(np.float32)
    vectors = [base[k] for k in rng.integers(0, 60, 150)] + [base[0]] * 200  # one vector holds more than half of all rows
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    got = W.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA), weights=weights).collect()
    check(rows, got, weights)
    by = {}
    for r in got:
        by.setdefault((r.component, r.deviation), set()).add(r.whitened)
    assert all(len(v) == 1 for v in by.values())  # copies are whitened once


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (1, []), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, 2.0]), (5, [1.0, 2.0]), (5, [3.0, -1.0]),
            (None, [0.5, 0.25]), (6, [-0.001, 7.0]), (7, [1.0, 1.0, 1.0]), (8, [2.0])]
    df = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)
    got = W.whiten(df).collect()
    twos = [r for r in got if r.vec_id == 5]
    assert len(twos) == 6 and {r.n for r in twos} == {4}
    assert len([r for r in got if r.vec_id is None]) == 2
    lone = [r for r in got if r.vec_id in (7, 8)]  # one vector of its length: nothing varies
    assert len(lone) == 4 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained is None for r in lone)
    assert not [r for r in got if r.vec_id in (0, 1, 2, 3, 4)]
    check([r for r in rows if r[0] in (5, 6, None)], [r for r in got if r.vec_id in (5, 6, None)])
    assert W.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = df.selectExpr("*", "1 AS x", "2 AS n", "3 AS component", "4 AS weight", "5 AS d", "6 AS w", "'k' AS key", "7 AS hot")
    assert sorted(map(repr, W.whiten(clash).select("vec_id", "component", "n", "deviation").collect())) == sorted(
        repr(r) for r in W.whiten(df).select("vec_id", "component", "n", "deviation").collect())


def test_constant_dimensions_and_large_entries(spark):
    rng = np.random.default_rng(1)
    small = [(i, [*map(float, rng.normal(size=2)), 4.0]) for i in range(30)]  # the third entry never varies
    check(small, W.whiten(spark.createDataFrame([(i, v, 0) for i, v in small], SCHEMA)).collect())
    large = [(0, [1e10, 1.0]), (1, [-1e10, 2.0]), (2, [3.0, 1e30]), (3, [5.0, 1.0])]
    got = W.whiten(spark.createDataFrame([(i, v, 0) for i, v in large], SCHEMA)).collect()
    assert {r.vec_id for r in got} == {0, 1, 3}  # 1e30 is no long
    assert [r.deviation for r in got if r.vec_id == 0] == [None, None]  # exact, but larger than a long


def test_exact_deviations_at_large_n():
    s = W.Space(10 ** 9, [10 ** 15 + 7, 10 ** 15 - 3])
    x = np.array([[10 ** 6 + 5, 10 ** 6 - 9], [1 << 45, 0]])
    assert [[int(v) for v in r] for r in s.deviations(x)] == [[10 ** 9 * int(v) - t for v, t in zip(r, s.sums, strict=True)] for r in x]
    assert W._squares(s.deviations(x)) == [None if v >= 1 << 63 else v for v in (
        sum((10 ** 9 * int(v) - t) ** 2 for v, t in zip(r, s.sums, strict=True)) for r in x)]
