import numpy as np
from pyspark.sql import functions as F

from riskspark.operators import calibrate as CA
from riskspark.operators import metrics as M
from riskspark.operators import model as MO
from riskspark.operators import scorecard as SC
from riskspark.operators import select as SE
from riskspark.operators import split as SP
from riskspark.sources import fixtures as fx
from tests import numpy_ref as R
from tests.conftest import SF_SMALL


def test_logistic_matches_newton(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(800, 3))
    y = (rng.uniform(size=800) < 1 / (1 + np.exp(-(0.4 + X @ [1.0, -0.5, 0.2])))).astype(int)
    df = spark.createDataFrame([(int(i), *map(float, X[i]), int(y[i])) for i in range(800)], "id int, a double, b double, c double, y int")
    model = MO.fit_logistic(df, ["a", "b", "c"], "y")
    n, n1 = len(y), y.sum()
    w = np.where(y == 1, n / (2 * n1), n / (2 * (n - n1)))
    b0, b = R.newton_logistic(X, y, w, C=1.0)
    assert abs(model.intercept - b0) < 1e-5
    assert np.allclose(model.coefficients.toArray(), b, atol=1e-5)
    own, coefs = MO.fit_newton(df, ["a", "b", "c"], "y")
    assert abs(own - b0) < 1e-9 and np.allclose(list(coefs.values()), b, atol=1e-9)


def test_newton_on_cells_of_bins(spark):
    rng = np.random.default_rng(10)
    X = rng.choice([-0.8, -0.1, 0.3, 1.1], size=(3000, 3))
    X = np.hstack([X, X[:, :1], np.full((3000, 1), 0.5)])  # a copy and a constant
    y = (rng.uniform(size=3000) < 1 / (1 + np.exp(-(0.9 + X[:, :3] @ [1.4, -0.6, 0.0])))).astype(int)
    names = list("abcde")
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(X, y)] + [(0.1,) * 5 + (None,)], ", ".join(f"{c} double" for c in names) + ", y int")
    assert MO.cells(df, names, "y").count() <= 2 * 4**3
    for weight, w in (("balanced", np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))), (None, np.ones(len(y)))):
        b0, b = R.newton_logistic(X, y, w, C=2.0)
        own, coefs = MO.fit_newton(df, names, "y", c_penalty=2.0, class_weight=weight)
        assert abs(own - b0) < 1e-8 and np.allclose(list(coefs.values()), b, atol=1e-8)
    import pytest

    with pytest.raises(ValueError):
        MO.fit_newton(df.where("y = 1"), names, "y")


def test_isotonic_matches_pava_with_interpolation(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.uniform(size=400), 2)
    y = (rng.uniform(size=400) < x).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, y int")
    model = CA.fit_isotonic(df, "x", "y")
    xs, fit = R.pava(x, y)
    probe = np.concatenate([xs, [xs[0] - 0.5, xs[-1] + 0.5, (xs[3] + xs[4]) / 2]])
    pdf = spark.createDataFrame([(float(v),) for v in probe], "x double")
    got = [r["p_good"] for r in CA.calibrated_good(pdf, model, "x").collect()]
    expect = np.interp(probe, xs, fit)
    assert np.allclose(got, expect, atol=1e-12)
    nan_mode = [r["p_good"] for r in CA.calibrated_good(pdf, model, "x", out_of_bounds="nan").collect()]
    assert nan_mode[len(xs)] is None and nan_mode[len(xs) + 1] is None


def test_collinear_rule_is_not_greedy(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=2000)
    c = 0.5 * a + np.sqrt(0.75) * rng.normal(size=2000)  # corr(A, C) ~ 0.5
    b = a + c  # corr(A, B) ~ corr(B, C) ~ 0.87
    df = spark.createDataFrame([(float(p), float(q), float(r)) for p, q, r in zip(a, b, c)], "A double, B double, C double")
    pairs = {(r["a"], r["b"]): r["r"] for r in SE.correlation_pairs(df, ["A", "B", "C"]).collect()}
    assert pairs[("A", "B")] > 0.7 and pairs[("B", "C")] > 0.7 and pairs[("A", "C")] <= 0.7
    iv = spark.createDataFrame([("A", 0.5), ("B", 0.4), ("C", 0.3)], "feature string, iv double")
    drops = sorted(r["feature"] for r in SE.collinear_drops(SE.correlation_pairs(df, ["A", "B", "C"]), iv, 0.7).collect())
    assert drops == ["B", "C"]


def test_no_feature_passes_iv_falls_back_to_top5(spark):
    iv = spark.createDataFrame([(f"f{i}", 1.0 + i) for i in range(7)], "feature string, iv double")
    got = [r["feature"] for r in SE.iv_selection(iv, 0.02, 0.55).collect()]
    assert got == ["f6", "f5", "f4", "f3", "f2"]


def test_auc_ks_against_numpy(spark):
    s = fx.scored(spark, SF_SMALL)
    pdf = s.toPandas()
    d = M.discrimination(s, "target", "raw_good").first()
    assert abs(d["auc"] - R.auc(pdf.target, pdf.raw_good)) < 1e-12
    order = np.argsort(-pdf.raw_good.to_numpy())
    thr = np.unique(pdf.raw_good)[::-1]
    P, N = (pdf.target == 1).sum(), (pdf.target == 0).sum()
    tpr = np.array([((pdf.raw_good >= t) & (pdf.target == 1)).sum() / P for t in thr])
    fpr = np.array([((pdf.raw_good >= t) & (pdf.target == 0)).sum() / N for t in thr])
    assert abs(d["ks_stat"] - np.max(tpr - fpr)) < 1e-12
    assert d["ks_threshold"] == thr[np.argmax(tpr - fpr)]
    del order


def test_deciles_with_heavy_ties_match_qcut(spark):
    rng = np.random.default_rng(5)
    scores = np.concatenate([np.full(5000, 600), rng.integers(300, 600, 3000)])
    target = rng.integers(0, 2, len(scores))
    df = spark.createDataFrame([(int(i), int(s), int(t)) for i, (s, t) in enumerate(zip(scores, target))], "id int, score int, target int")
    got = {r["id"]: r["decile"] for r in SC.with_decile(df).collect()}
    ref = R.qcut_codes(scores)
    assert all(got[i] == ref[i] for i in range(len(scores)))
    assert max(ref) < 9


def test_master_scale_band_edges(spark):
    df = spark.createDataFrame([(i, s, 0.1) for i, s in enumerate([300, 301, 350, 351, 900, 901])], "id int, score int, pd double")
    bands = {r["Score_Band"]: r["Volume"] for r in SC.master_scale(df).collect()}
    assert bands == {"(300, 350]": 2, "(350, 400]": 1, "(850, 900]": 1}


def test_split_disjoint_complete_stratified(spark, monkeypatch):
    monkeypatch.setattr(SP, "RANK_ROWS", 100)  # two digits of the hash
    df = spark.createDataFrame([(i, int(i % 10 < 3)) for i in range(5000)], "id int, y int")
    out = SP.stratified_split(df, "y", "id").cache()
    assert out.count() == 5000 and out.select("id").distinct().count() == 5000
    counts = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert counts[(1, "test")] == 300 and counts[(0, "test")] == 700
    assert counts[(1, "val")] == 300 and counts[(0, "val")] == 700


def test_balanced_weights(spark):
    df = spark.createDataFrame([(i, int(i < 25)) for i in range(100)], "id int, y int")
    w = {r["y"]: r["weight"] for r in MO.balanced_weights(df, "y").select("y", "weight").distinct().collect()}
    assert np.isclose(w[1], 100 / 50) and np.isclose(w[0], 100 / 150)


def test_running_totals_many_blocks(spark):
    from riskspark.operators.cumulative import running_totals

    rng = np.random.default_rng(6)
    v = rng.permutation(3000).astype(float)
    a = rng.integers(0, 5, 3000)
    df = spark.createDataFrame([(float(x), int(y)) for x, y in zip(v, a)], "v double, a long")
    ref = np.cumsum(a[np.argsort(v)])
    for rows in (170, 1_000_000):  # many blocks and one
        out = sorted(running_totals(df, "v", ["a"], with_next=True, block_rows=rows).collect(), key=lambda r: r["v"])
        assert [r["cum_a"] for r in out] == list(ref)
        assert [r["next_v"] for r in out[:-1]] == [r["v"] for r in out[1:]] and out[-1]["next_v"] is None
        desc = sorted(running_totals(df, "v", ["a"], descending=True, block_rows=rows).collect(), key=lambda r: -r["v"])
        assert [r["cum_a"] for r in desc] == list(np.cumsum(a[np.argsort(-v)]))


def test_running_totals_do_not_depend_on_block_size(spark):
    from riskspark.operators.cumulative import running_totals

    rows = [("a", None, 3), ("a", float("nan"), 5), ("a", 1.0, 7), ("a", 2.0, 11), ("b", 9.0, 13), ("b", None, 17)]
    df = spark.createDataFrame(rows, "g string, v double, a long")
    ints = spark.createDataFrame([(i, i) for i in range(20)], "k int, a long")
    for descending in (False, True):
        got = [sorted(map(str, running_totals(df, "v", ["a"], ["g"], descending, True, n).collect())) for n in (1, 2, 100)]
        assert got[0] == got[1] == got[2]
    by = {(r["g"], str(r["v"])): r["cum_a"] for r in running_totals(df, "v", ["a"], ["g"], block_rows=1).collect()}
    assert by == {("a", "1.0"): 7, ("a", "2.0"): 18, ("a", "nan"): 23, ("a", "None"): 26, ("b", "9.0"): 13, ("b", "None"): 30}
    down = {(r["g"], str(r["v"])): r["cum_a"] for r in running_totals(df, "v", ["a"], ["g"], True, block_rows=1).collect()}
    assert down[("a", "nan")] == 5 and down[("a", "None")] == 26
    for n in (3, 100):
        out = running_totals(ints, "k", ["a"], with_next=True, block_rows=n)
        assert dict(out.dtypes)["next_k"] == "int" and {r["k"]: r["next_k"] for r in out.collect()} == {i: i + 1 if i < 19 else None for i in range(20)}


def test_auc_of_billions_of_rows_does_not_overflow(spark):
    from riskspark.operators import metrics as ME

    hist = spark.createDataFrame([(0.9, 5_000_000_000, 0), (0.1, 0, 5_000_000_000)], "threshold double, pos long, neg long")
    assert F.try_divide is not None
    run = ME.from_histogram(hist)
    assert ME.discrimination_of(run).first()["auc"] == 1.0


def test_discrimination_does_not_depend_on_blocks(spark):
    rng = np.random.default_rng(8)
    p = np.where(rng.uniform(size=3000) < 0.3, 0.5, np.round(rng.uniform(size=3000), 4))
    rows = [(float(a), int(b)) for a, b in zip(p, rng.uniform(size=3000) < p)] + [(None, 1), (None, 0)]
    df = spark.createDataFrame(rows, "prob double, target int")
    got = [sorted(map(str, M.roc_points(df, block_rows=n).collect())) for n in (1_000_000, 700, 40)]
    assert got[0] == got[1] == got[2] and len(M.block_edges(df, "prob", 40)) > 30
    one, many = (M.discrimination_of(M.roc_points(df, block_rows=n)).first() for n in (1_000_000, 40))
    assert one["ks_threshold"] == many["ks_threshold"] and np.isclose(one["auc"], many["auc"], rtol=1e-13)
    assert M.roc_points(df.limit(0)).collect() == [] and M.discrimination(df.limit(0)).first()["auc"] is None


def test_discrimination_writes_no_table(spark, monkeypatch):
    from riskspark import session

    monkeypatch.setattr(session, "checkpoint_dir", lambda *a: (_ for _ in ()).throw(AssertionError("a table is written")))
    assert M.discrimination(fx.scored(spark, SF_SMALL), "target", "raw_good").first()["auc"] > 0.5
