import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from riskspark.functions import exprs as X
from riskspark.operators import engineer as E
from riskspark.operators import woe as WO


def test_emp_length_cases(spark):
    df = spark.createDataFrame([("< 1 year",), ("10+ years",), (None,), ("n/a",), ("1 year",)], "e string")
    got = [r[0] for r in df.select(X.emp_length_years("e")).collect()]
    assert got == [1, 10, 1, 0, 1]


def test_month_year_parse(spark):
    df = spark.createDataFrame([("Dec-2015",), ("bad",), (None,)], "d string")
    got = [r[0] for r in df.select(X.parse_month_year("d")).collect()]
    assert got == [dt.date(2015, 12, 1), None, None]


def test_credit_history_months_truncates(spark):
    df = spark.createDataFrame([(dt.date(2015, 12, 1), dt.date(2010, 1, 1))], "a date, b date")
    got = df.select(X.months_between_truncated("a", "b")).first()[0]
    assert got == int((dt.date(2015, 12, 1) - dt.date(2010, 1, 1)).days / 30.4375)


def test_mode_and_median_imputation(spark):
    df = spark.createDataFrame([(1, "b", 1.0), (2, "a", 2.0), (3, "a", None), (4, "b", 10.0), (5, None, 4.0)],
                               "id int, s string, x double")
    vals = E.imputation_values(df, exclude=("id",))
    assert vals == {"x": 3.0, "s": "a"}
    assert E.imputation_values(df.where("x IS NOT NULL"), exclude=("id",)) == {"s": "b"}
    out = {r["id"]: (r["s"], r["x"]) for r in E.impute(df, vals).collect()}
    assert out[3] == ("a", 3.0) and out[5] == ("a", 4.0)


def test_all_null_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, None)], "id int, s string, x double")
    vals = E.imputation_values(df, exclude=("id",))
    assert vals == {"x": 0.0}


def test_half_even_matches_numpy(spark):
    import numpy as np

    xs = [2.5, 3.5, -0.5, 2.675, 0.125, 1.005, 437.35, 12.345]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got0 = [r[0] for r in df.select(X.round_half_even("x", 0)).collect()]
    got2 = [r[0] for r in df.select(X.round_half_even("x", 2)).collect()]
    got1 = [r[0] for r in df.select(X.round_half_even("x", 1)).collect()]
    assert got0 == [float(v) for v in np.round(xs, 0)]
    assert got2 == [float(v) for v in np.round(xs, 2)]
    assert got1 == [float(v) for v in np.round(xs, 1)]


def test_truncate_shortest_decimal(spark):
    df = spark.createDataFrame([(8.2,), (-1.23456,), (3.9999,), (0.0,)], "x double")
    got = [r[0] for r in df.select(X.truncate_decimals("x", 3)).collect()]
    assert got == [8.2, -1.234, 3.999, 0.0]


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 2.0000001, 5.0, 7.0, None, float("nan")]], "x double")
    got = [r[0] for r in df.select(X.right_closed_bin("x", [2.0, 5.0])).collect()]
    assert got == [0, 0, 1, 1, 2, None, None]


def test_at_or_above_index(spark):
    pts = [380, 385, 390, 395]
    df = spark.createDataFrame([(v,) for v in [379, 380, 384, 395, 999, None]], "x int")
    got = [r[0] for r in df.select(X.at_or_above_index(F.col("x"), pts)).collect()]
    assert got == [-1, 0, 0, 3, 3, -1]


def test_equal_width_edges(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 1.0, 5.0, 10.0]], "x double")
    edges = WO.equal_width_edges(df, "x", 5)
    assert edges == pytest.approx([-0.01, 2.0, 4.0, 6.0, 8.0, 10.0])


def test_text_helpers(spark):
    df = spark.createDataFrame([(0.1234, 2.5e9, 1500.0, 999)], "p double, m double, d double, k int")
    r = df.select(X.percent_text("p"), X.compact_money("m"), X.compact_defaults("d"), X.compact_count("k")).first()
    assert tuple(r) == ("12.34%", "2.50bn", "1.50K", "999")
    assert df.select(X.percent_text(F.lit(None).cast("double"))).first()[0] is None
    assert math.isclose(X.DAYS_PER_MONTH, 30.4375)


def test_integer_column_with_fractional_median(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 3), (5, 4)], "id int, k int")
    vals = E.imputation_values(df, exclude=("id",))
    assert vals == {"k": 2.5}
    out = {r["id"]: r["k"] for r in E.impute(df, vals).collect()}
    assert out[3] == 2.5 and out[1] == 1.0


def test_exact_median_with_hot_value(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    x = rng.normal(size=30001)
    x[: 10000] = 0.123  # a third of the rows share one value
    x[5:40] = np.nan
    df = spark.createDataFrame([(i, None if np.isnan(v) else float(v)) for i, v in enumerate(x)], "id int, x double")
    assert E.imputation_values(df, exclude=("id",))["x"] == float(np.nanmedian(x))
    even = df.where("id % 2 = 0 OR x IS NULL")
    ev = np.array([r["x"] for r in even.collect() if r["x"] is not None])
    assert E.imputation_values(even, exclude=("id",))["x"] == float(np.median(ev))


def test_modes_of_hot_and_all_distinct_texts(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}", f"u{i:05d}", None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, a string, b string, c string")
    assert E.imputation_values(df, exclude=("id",)) == {"a": "hot", "b": "u00000"}


def test_texts_equal_exact_formatting(spark):
    import random

    from riskspark.functions import exprs as X

    rnd = random.Random(4)
    xs = [k / 100000 for k in range(5, 100000, 250)] + [0.125, 0.375, 0.00005, 0.0, 1.0, -0.00001, 2.675, 1e-9] + [rnd.random() for _ in range(500)]
    ms = [x * 10 ** rnd.randint(0, 12) for x in xs] + [2500.0, 1250000.0, 1e9, 0.5, 1.5]
    p = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").orderBy("i").select(X.percent_text("x")).collect()]
    assert p == [f"{x:.2%}" for x in xs]

    def money(v):
        return f"{v / 1e9:.2f}bn" if abs(v) >= 1e9 else f"{v / 1e6:.2f}M" if abs(v) >= 1e6 else f"{v / 1e3:.1f}K"

    m = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(ms)], "i int, x double").orderBy("i").select(X.compact_money("x")).collect()]
    assert m == [money(x) for x in ms]
