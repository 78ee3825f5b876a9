import numpy as np

from riskspark.operators import tree as TR
from riskspark.plans.q_prep import engineered
from tests import numpy_ref as R
from tests.conftest import SF_SMALL

FEATS = ["loan_amnt", "installment", "annual_inc", "emp_length", "term_int", "credit_hist_months"]


import pytest


@pytest.mark.parametrize("block_rows,stretch", [(40, 16), (1_000_000, 4096)])
def test_best_first_matches_numpy(spark, block_rows, stretch):
    df = engineered(spark, SF_SMALL).cache()
    cuts = TR.tree_cuts(df, FEATS, "loan_status_binary", max_leaves=6, min_samples_leaf=0.05, block_rows=block_rows, stretch=stretch)
    pdf = df.toPandas()
    for f in FEATS:
        ref = R.best_first_tree(pdf[f].to_numpy(float), pdf["loan_status_binary"].to_numpy(int), max_leaves=6,
                                min_leaf=R.ceil_frac(0.05, len(pdf)))
        assert np.allclose(cuts[f], ref) and len(cuts[f]) == len(ref), f


def test_depth_mode_matches_numpy(spark):
    df = engineered(spark, SF_SMALL).cache()
    cuts = TR.tree_cuts(df, ["annual_inc", "loan_amnt"], "loan_status_binary", max_leaves=None, min_samples_leaf=60, max_depth=3, stretch=30)
    pdf = df.toPandas()
    for f in ["annual_inc", "loan_amnt"]:
        ref = R.best_first_tree(pdf[f].to_numpy(float), pdf["loan_status_binary"].to_numpy(int), min_leaf=60, max_depth=3)
        assert np.allclose(cuts[f], ref) and len(cuts[f]) == len(ref), f


def test_constant_feature_no_cut(spark):
    df = spark.createDataFrame([(i, 5.0, i % 2) for i in range(100)], "id int, c double, y int")
    assert TR.tree_cuts(df, ["c"], "y", 6, 0.05) == {"c": []}


def test_both_limits_grow_best_first_within_the_depth(spark):
    rng = np.random.default_rng(8)
    x = rng.uniform(0, 2000, 2000).round(1)
    y = (rng.uniform(size=2000) < 0.2 + 0.6 * ((x // 250) % 2)).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, y int")
    whole = TR.tree_cuts(df, ["x"], "y", max_leaves=None, max_depth=4, min_samples_leaf=50)["x"]
    both = TR.tree_cuts(df, ["x"], "y", max_depth=4, min_samples_leaf=50)["x"]
    best = TR.tree_cuts(df, ["x"], "y", max_leaves=6, min_samples_leaf=50)["x"]
    assert len(both) == 5 and set(both) <= set(whole) and len(whole) >= 5
    assert np.allclose(TR.tree_cuts(df, ["x"], "y", max_leaves=6, max_depth=10, min_samples_leaf=50)["x"], best)
    shallow = TR.tree_cuts(df, ["x"], "y", max_leaves=6, max_depth=1, min_samples_leaf=50)["x"]
    assert len(shallow) == 1 and shallow[0] in whole


def test_hull_points_are_those_of_the_convex_hull():
    rng = np.random.default_rng(4)
    for k in range(60):
        n = int(rng.integers(1, 60))
        x = np.cumsum(rng.integers(1, 4, n))
        y = np.cumsum(rng.integers(0, 4, n) if k % 3 else np.minimum(rng.integers(0, 2, n), 1))
        keep = TR.hull_points(x, y, np.zeros(n, int))

        def inside(i):  # strictly between a lower and an upper line of two other points
            turns = [(x[b] - x[a]) * (y[i] - y[a]) - (y[b] - y[a]) * (x[i] - x[a]) for a in range(i) for b in range(i + 1, n)]
            return any(t > 0 for t in turns) and any(t < 0 for t in turns)

        assert [not inside(i) for i in range(n)] == keep.tolist()


@pytest.mark.parametrize("kind", ["random", "tied", "steps", "pure"])
@pytest.mark.parametrize("stretch", [5, 64])
def test_cuts_from_hulls_are_those_of_all_values(spark, kind, stretch):
    rng = np.random.default_rng(5)
    n = 1500
    x = {"random": rng.normal(size=n), "tied": rng.integers(0, 40, n).astype(float), "steps": rng.uniform(0, 100, n), "pure": np.arange(n) * 1.0}[kind]
    y = {"random": rng.uniform(size=n) < 1 / (1 + np.exp(-x)), "tied": rng.integers(0, 2, n), "steps": rng.uniform(size=n) < 0.2 + 0.6 * ((x // 20) % 2),
         "pure": (np.arange(n) // 300) % 2}[kind].astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, y int")
    for arguments in ({"max_leaves": 6, "min_samples_leaf": 0.05}, {"max_leaves": None, "max_depth": 3, "min_samples_leaf": 40}):
        reference = R.best_first_tree(x, y, max_leaves=arguments["max_leaves"], max_depth=arguments.get("max_depth"),
                                      min_leaf=R.ceil_frac(0.05, n) if arguments["max_leaves"] else 40)
        cuts = TR.tree_cuts(df, ["x"], "y", stretch=stretch, **arguments)["x"]
        assert np.allclose(cuts, reference) and len(cuts) == len(reference)


def test_a_round_reads_hulls_and_few_values(spark, monkeypatch):
    n = 20_000
    rng = np.random.default_rng(6)
    x = rng.permutation(n) / 3.0
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, rng.uniform(size=n) < 0.3 + 0.4 * x / x.max())], "x double, y int")
    read = []
    plain = TR.best_splits

    def counted(hist, hulls, *rest):
        best, parts = plain(hist, hulls, *rest)
        read.append(hulls.count() + sum(hist.where(f"cum_n between {low} and {high}").count() for _, low, high in parts))
        return best, parts

    monkeypatch.setattr(TR, "best_splits", counted)
    TR.tree_cuts(df, ["x"], "y", stretch=256)
    assert len(read) == 5 and max(read) < 0.35 * n  # two stretches of each leaf, and the hulls
