"""Property checks against brute force (small random inputs, few examples: each runs Spark jobs)."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskspark.functions.exprs import right_closed_bin
from riskspark.operators import metrics as M
from riskspark.operators.cumulative import threshold_sums

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(st.integers(min_value=250, max_value=700), min_size=1, max_size=60)
cutoffs = st.lists(st.integers(min_value=200, max_value=750), min_size=1, max_size=12, unique=True)


@SETTINGS
@given(vals=values, cuts=cutoffs, side=st.sampled_from(["ge", "le"]))
def test_threshold_sums_equal_brute_force(spark, vals, cuts, side):
    w = [float(i % 3) for i in range(len(vals))]
    df = spark.createDataFrame(list(zip(vals, w)), "v int, w double")
    out = {r["threshold"]: r for r in threshold_sums(df, "v", cuts, {"sw": F.col("w")}, side=side).collect()}
    v, wa = np.array(vals), np.array(w)
    for c in cuts:
        mask = v >= c if side == "ge" else v <= c
        r = out[float(c)]
        assert r["rows"] == mask.sum()
        assert (r["sw"] or 0.0) == wa[mask].sum()
        assert r["total_rows"] == len(vals)


@SETTINGS
@given(vals=st.lists(st.floats(min_value=-5, max_value=5, allow_nan=False), min_size=1, max_size=40),
       cuts=st.lists(st.floats(min_value=-5, max_value=5, allow_nan=False), min_size=1, max_size=6, unique=True))
def test_right_closed_bin_equals_searchsorted(spark, vals, cuts):
    df = spark.createDataFrame([(float(x),) for x in vals], "x double")
    got = [r[0] for r in df.select(right_closed_bin("x", cuts)).collect()]
    assert got == list(np.searchsorted(np.sort(cuts), vals, side="left"))


def test_score_distribution_matches_numpy_histogram(spark):
    rng = np.random.default_rng(11)
    s = rng.integers(300, 600, 3000)
    y = rng.integers(0, 2, 3000)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(s, y)], "score int, target int")
    got = {(r["label"], r["bin"]): r["density"] for r in M.score_distribution(df, "score", "target", 30).collect()}
    edges = np.histogram_bin_edges(s, 30)
    for cls in (0, 1):
        dens, _ = np.histogram(s[y == cls], bins=edges, density=True)
        for b, d in enumerate(dens):
            assert np.isclose(got.get((cls, b), 0.0), d, rtol=1e-12, atol=0)
