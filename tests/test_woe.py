import math

import numpy as np
from pyspark.sql import functions as F

from riskspark.operators import woe as WO


def test_constant_feature_one_bin_iv_zero(spark):
    df = spark.createDataFrame([(i, 1.0, i % 2) for i in range(10)], "id int, c double, y int")
    bt = WO.fit_woe(df, "y", {"c": []})
    rows = bt.collect()
    assert len(rows) == 1 and rows[0]["iv"] == 0.0


def test_single_class_target_has_no_map(spark):
    df = spark.createDataFrame([(i, float(i), "a" if i < 5 else "b", 1) for i in range(10)], "id int, x double, s string, y int")
    bt = WO.fit_woe(df, "y", {"x": [4.5]}, ["s"])
    assert all(not r["valid"] for r in bt.collect())
    iv = {r["feature"]: r["iv"] for r in WO.iv_summary(bt).collect()}
    assert iv == {"x": 0.0, "s": 0.0}
    enc = WO.transform_woe(df, bt, keep=["id"])
    assert enc.columns == ["id"]


def test_laplace_formula_and_unseen(spark):
    data = [("a", 1)] * 6 + [("a", 0)] * 2 + [("b", 1)] * 3 + [("b", 0)] * 5 + [(None, 1)] * 2
    df = spark.createDataFrame([(i, s, y) for i, (s, y) in enumerate(data)], "id int, s string, y int")
    bt = {r["category"]: r for r in WO.fit_woe(df, "y", None, ["s"]).collect()}
    G, B, k = 11, 7, 3
    dg, db = (6 + 0.5) / (G + 0.5 * k), (2 + 0.5) / (B + 0.5 * k)
    assert math.isclose(bt["a"]["woe"], math.log(dg / db))
    assert "nan" in bt
    new = spark.createDataFrame([(100, "zzz"), (101, None), (102, "a")], "id int, s string")
    enc = {r["id"]: r["s"] for r in WO.transform_woe(new, WO.fit_woe(df, "y", None, ["s"]), keep=["id"]).collect()}
    assert enc[100] == 0.0 and math.isclose(enc[101], bt["nan"]["woe"]) and math.isclose(enc[102], bt["a"]["woe"])


def test_numeric_transform_null_and_legacy(spark):
    df = spark.createDataFrame([(i, float(i), i % 3 == 0) for i in range(30)], "id int, x double, y boolean").withColumn(
        "y", F.col("y").cast("int"))
    bt = WO.fit_woe(df, "y", {"x": [9.5, 19.5]})
    new = spark.createDataFrame([(1, None), (2, 25.0)], "id int, x double")
    enc = {r["id"]: r["x"] for r in WO.transform_woe(new, bt, keep=["id"]).collect()}
    assert enc[1] == 0.0
    legacy = {r["id"]: r["x"] for r in WO.transform_woe(new, bt, keep=["id"], unseen=None).collect()}
    assert legacy[1] is None


def test_categorical_join_equals_the_bin_table(spark):
    rng = np.random.default_rng(1)
    cats = [f"c{int(v)}" for v in rng.integers(0, 1500, 4000)]
    ys = rng.integers(0, 2, 4000)
    df = spark.createDataFrame([(i, c, int(y)) for i, (c, y) in enumerate(zip(cats, ys))], "id int, s string, y int")
    bt = WO.fit_woe(df, "y", None, ["s"])
    want = {r["category"]: r["woe"] for r in bt.collect()}
    got = {r["id"]: r["s"] for r in WO.transform_woe(df, bt, keep=["id"]).collect()}
    assert got == {i: want[c] for i, c in enumerate(cats)}


def test_iv_nonnegative_and_totals(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=500)
    y = (rng.uniform(size=500) < 1 / (1 + np.exp(-x))).astype(int)
    df = spark.createDataFrame([(i, float(a), int(b)) for i, (a, b) in enumerate(zip(x, y))], "id int, x double, y int")
    bt = WO.fit_woe(df, "y", {"x": [-1.0, 0.0, 1.0]}).collect()
    assert sum(r["total"] for r in bt) == 500
    assert all(r["iv"] >= 0 for r in bt)


def _many_categories(spark, n=4000):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        a = "hot" if rng.uniform() < 0.4 else f"a{int(rng.integers(900))}"
        rows.append((i, a, f"b{int(rng.integers(3))}", None if i % 17 == 0 else f"c{int(rng.zipf(1.6)) % 500}", float(rng.normal()), int(rng.integers(2))))
    return spark.createDataFrame(rows, "id int, a string, b string, c string, x double, y int")


def test_categories_by_literal_broadcast_and_join_are_the_same(spark, monkeypatch):
    df = _many_categories(spark)
    bt = WO.fit_woe(df, "y", {"x": [0.0]}, ["a", "b", "c"]).cache()
    want = {(r["feature"], r["category"]): r["woe"] for r in bt.where("kind = 'cat'").collect()}
    new = df.unionByName(spark.createDataFrame([(9000, "unseen", None, "c1", None, 0), (9000, "unseen", None, "c1", None, 0)], df.schema))
    got = []
    for frequent, few in ((100_000, 0), (200, 100_000), (200, 0), (2, 0)):
        monkeypatch.setattr(WO, "FREQUENT", frequent)
        monkeypatch.setattr(WO, "BROADCAST_CATEGORIES", few)
        got.append(sorted(map(tuple, WO.transform_woe(new, bt, keep=["id"], features=["a", "b", "c", "x"]).collect())))
    assert got[0] == got[1] == got[2] == got[3] and len(got[0]) == 4002
    source = {r["id"]: r for r in new.collect()}
    for i, a, b, c, _ in got[0]:
        r = source[i]
        assert (a, b, c) == tuple(want.get((f, "nan" if r[f] is None else r[f]), 0.0) for f in "abc")
    legacy = WO.transform_woe(new, bt, keep=["id"], features=["a"], unseen=None).where("id = 9000").collect()
    assert [r["a"] for r in legacy] == [None, None]


def test_exchanges_of_the_encoding_do_not_grow_with_the_features(spark, monkeypatch):
    df = _many_categories(spark, 1500)
    bt = WO.fit_woe(df, "y", None, ["a", "b", "c"]).cache()
    plan = lambda fs: WO.transform_woe(df, bt, keep=["id"], features=fs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan(["b"]) and "Join" not in plan(["b"])  # three categories: all literals
    assert "Exchange hashpartitioning" not in plan(["a", "c"])  # the others are broadcast
    monkeypatch.setattr(WO, "BROADCAST_CATEGORIES", 0)
    one, two = (plan(fs).count("Exchange hashpartitioning") for fs in (["a"], ["a", "c"]))
    assert one == two <= 3


def test_rows_of_frequent_categories_are_not_joined(spark, monkeypatch):
    df = _many_categories(spark, 3000)
    bt = WO.fit_woe(df, "y", None, ["a"]).cache()
    monkeypatch.setattr(WO, "BROADCAST_CATEGORIES", 0)
    seen = []
    plain = WO._join_others
    monkeypatch.setattr(WO, "_join_others", lambda rows, *rest: seen.append(rows.where("a is null").count()) or plain(rows, *rest))
    WO.transform_woe(df, bt, keep=["id"], features=["a"])
    assert seen == [df.where("a != 'hot'").count()]
