"""Pooling in blocks, cuts of long stretches and lookups against a plain pool-adjacent-violators."""

import numpy as np
import pytest

from riskspark.operators import calibrate as CA
from riskspark.operators import isotonic as ISO
from tests import numpy_ref as R


def data(kind):
    rng = np.random.default_rng(9)
    n = 700
    x = rng.permutation(n) / n
    w = np.ones(n)
    if kind == "random":
        y = (rng.uniform(size=n) < x).astype(float)
    elif kind == "ties":
        x = np.round(rng.uniform(size=n), 2)
        y = rng.integers(0, 2, n).astype(float)
    elif kind == "weights":
        y, w = rng.normal(size=n) + 3 * x, rng.uniform(0.1, 9, n)
    elif kind == "rising":
        y = x**2
    elif kind == "falling":
        y = -x
    elif kind == "steep":  # neighbouring slopes differ by orders of magnitude
        y = np.exp(18 * x)
    elif kind == "constant":
        y = np.full(n, 0.25)
    else:  # saw: every tooth rises, all teeth are alike
        y = (x * 10) % 1
    return x, y, w


KINDS = ["random", "ties", "weights", "rising", "falling", "steep", "constant", "saw"]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("block,few", [(1_000_000, 20_000), (60, 10)])
def test_fit_equals_plain_pooling(spark, kind, block, few):
    x, y, w = data(kind)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(x, y, w)], "x double, y double, w double")
    fit = ISO.fit(df, "x", "y", "w", block_rows=block, few=few)
    xs, want = R.pava(x, y, w)
    probe = np.concatenate([xs, (xs[1:] + xs[:-1]) / 2, [xs[0] - 1, xs[-1] + 1]])
    frame = spark.createDataFrame([(float(v),) for v in probe], "x double")
    got = {r["x"]: r["p"] for r in fit.values(frame, "x", "p").collect()}
    assert np.allclose([got[v] for v in probe], np.interp(probe, xs, want), rtol=1e-9, atol=1e-9)
    if few == 10:  # by cells and by one array alike
        fit.few = 20_000
        assert {r["x"]: r["p"] for r in fit.values(frame, "x", "p").collect()} == pytest.approx(got, rel=1e-12, abs=1e-12)
    # both ends of every pooled stretch, by rising x and y
    ends = sorted(map(tuple, fit.boundaries.collect()))
    assert len({e[0] for e in ends}) == len(ends) == fit.n and (np.diff([e[1] for e in ends]) >= -1e-12).all()


def test_points_without_value_and_empty_input(spark):
    rows = [(0.1, 1, 1.0), (None, 0, 1.0), (float("nan"), 0, 1.0), (0.2, None, 1.0), (0.3, 0, 0.0), (0.4, 1, None), (0.5, 1, 2.0), (-0.0, 0, 1.0), (0.0, 1, 1.0)]
    df = spark.createDataFrame(rows, "x double, y int, w double")
    fit = ISO.fit(df, "x", "y", "w")
    assert sorted(map(tuple, fit.boundaries.collect())) == [(0.0, 0.5), (0.1, 1.0), (0.5, 1.0)]
    got = CA.calibrated_good(df, fit, "x", out_of_bounds="nan").collect()
    assert [r["p_good"] for r in got if r["x"] is None or r["x"] != r["x"]] == [None, None]
    empty = ISO.fit(df.limit(0), "x", "y", "w")
    assert empty.n == 0 and [r["p_good"] for r in CA.calibrated_good(df.limit(2), empty, "x").collect()] == [None, None]


def test_saved_fit_is_the_same(spark, tmp_path):
    x, y, w = data("random")
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(x, y, w)], "x double, y double, w double")
    fit = ISO.fit(df, "x", "y")
    fit.write(str(tmp_path / "iso"))
    again = ISO.IsotonicFit.load(spark, str(tmp_path / "iso"))
    a, b = (sorted(map(tuple, f.values(df, "x", "p").collect())) for f in (fit, again))
    assert a == b and (again.low, again.high) == (fit.low, fit.high)


def test_lookup_of_few_boundaries_needs_no_join(spark):
    x, y, _ = data("random")
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(x, y)], "x double, y double")
    plan = CA.calibrated_good(df, ISO.fit(df, "x", "y"), "x")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Python" not in plan


def test_driver_holds_cuts_of_long_parts_only(spark, monkeypatch):
    x, y, w = data("rising")
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(x, y)], "x double, y double")
    seen = []
    cut = ISO._cut
    monkeypatch.setattr(ISO, "_cut", lambda run, parts, n: seen.append(len(parts)) or cut(run, parts, n))
    ISO.fit(df, "x", "y", block_rows=100)
    assert seen and max(seen) <= 2 * 700 // 100
