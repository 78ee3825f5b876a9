"""Order statistics by radix selection against NumPy."""

import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import engineer as EN
from riskspark.operators import ranks as RK
from riskspark.operators import scorecard as SC
from riskspark.sources import io

ODD = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf,
       3.0, 2.0**52 - 0.5, 2.0**53, 1 / 3, 1e-300, 1e300, 0.1 + 0.2, 0.3]


def test_image_is_the_ordered_bits_of_a_double(spark):
    rng = np.random.default_rng(1)
    random_bits = [v for v in struct.unpack("<3000d", rng.bytes(24000)) if v == v]
    powers = [s * math.ldexp(m, e) for e in range(-1074, 1024, 7) for m in (1.0, 1.0 - 2**-53, 1.0 + 2**-52) for s in (1, -1) if abs(math.ldexp(m, e)) < math.inf]
    values = ODD + random_bits + powers
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    got = df.select("x", RK.double_image(F.col("x")).alias("i")).collect()
    for r in got:
        if r["x"] is None or r["x"] != r["x"]:
            assert r["i"] is None
        else:
            bits = struct.unpack("<q", struct.pack("<d", abs(r["x"])))[0]
            assert r["i"] == (-bits if r["x"] < 0 else bits) and RK.double_of(r["i"]) == r["x"]


def test_medians_of_odd_columns(spark):
    rng = np.random.default_rng(2)
    n = 4000
    cols = {
        "distinct": rng.permutation(n) / 7.0,
        "hot": np.where(rng.uniform(size=n) < 0.6, 42.0, rng.normal(size=n)),
        "wide": rng.choice(np.array(ODD), n),
        "near": 1.0 + rng.permutation(n) * 2.0**-52,
        "zeros": np.where(np.arange(n) % 2 == 0, 0.0, -0.0),
    }
    rows = [tuple(None if (i + k) % 11 == 0 else float("nan") if (i + k) % 13 == 0 else float(c[i]) for k, c in enumerate(cols.values())) + (None, i % 2) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", nothing double, whole int")
    got = EN.exact_medians(df, [*cols, "nothing", "whole"])
    assert set(got) == {*cols, "whole"} and got["whole"] == 0.5
    for k, c in enumerate(cols):
        values = np.sort([r[k] for r in rows if r[k] is not None and r[k] == r[k]])
        m = len(values)
        assert got[c] == (values[(m - 1) // 2] + values[m // 2]) / 2


def test_shuffles_hold_buckets_only(spark):
    """Each round's exchange comes after a partial count by column and bucket."""
    df = spark.range(200_000).select((F.col("id") * 1.5).alias("a"), F.xxhash64("id").cast("double").alias("b"))
    assert EN.exact_medians(df, ["a"]) == {"a": (99_999 * 1.5 + 100_000 * 1.5) / 2}
    got = RK.values_at(df, {"b": RK.double_image(F.col("b"))}, lambda n: F.array(F.lit(0).cast("bigint"), n - 1))
    ends = df.agg(F.min("b"), F.max("b")).first()
    assert sorted(map(RK.double_of, got["b"].values())) == sorted(ends)


def test_quantile_edges_of_distinct_doubles(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=5003) * 10.0 ** rng.integers(-5, 6, 5003)
    df = spark.createDataFrame([(float(v), int(i % 2)) for i, v in enumerate(x)], "score double, target int")
    got = SC.decile_edges(df)
    assert np.allclose(got, np.quantile(x, np.linspace(0, 1, 11)), rtol=1e-12)
    table = SC.decile_table(df).collect()
    assert sum(r["volume"] for r in table) == 5003 and max(r["volume"] for r in table) - min(r["volume"] for r in table) <= 1
    assert SC.decile_edges(df.limit(0)) == []
    assert SC.decile_edges(spark.createDataFrame([(5, 1)], "score int, target int")) == [5.0]


@pytest.mark.parametrize("n", [0, 1, 7, 500, 999, 1000, 5000])
def test_sample_is_the_smallest_hashes(spark, n):
    import hashlib

    df = spark.range(1000).withColumn("v", F.col("id") % 3)
    got = sorted(r["id"] for r in io.sample_rows(df, n, 42, "id").collect())
    order = sorted(range(1000), key=lambda i: hashlib.md5(f"{i}|42".encode()).hexdigest())
    assert got == sorted(order[:n])
    if 0 < n < 1000:
        assert "TakeOrdered" not in io.sample_rows(df, n, 42, "id")._jdf.queryExecution().executedPlan().toString()


def test_sample_of_rows_that_share_their_key(spark):
    df = spark.createDataFrame([(1, i) for i in range(400)] + [(2, 7)] * 300 + [(None, 5)] * 30, "id int, v int")
    for n in (1, 150, 399, 500, 720):
        assert io.sample_rows(df, n, 7, "id").count() == n
    a, b = (sorted(map(tuple, io.sample_rows(d, 150, 7, "id").collect()), key=str) for d in (df, df.repartition(5)))
    assert a == b


def _told(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def told(v):
        seen.add(1)
        return v

    return seen, told


def test_medians_read_their_rows_once(spark):
    seen, told = _told(spark)
    df = spark.range(1000).select(told(F.col("id").cast("double")).alias("x"))
    assert RK.medians(df, {"x": F.col("x")}) == {"x": 499.5}
    assert seen.value == 1000


def test_staged_images_equal_the_single_expression(spark):
    values = [0.0, -0.0, 1.0, -1.5, 2.0 ** -1022, 2.0 ** -1074, 1.7e308, float("inf"), -float("inf"), float("nan"), None, 0.1, 3.0, 1 - 2.0 ** -53]
    df = spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)
    one = [r[0] for r in df.select(RK.double_image(F.col("x"))).collect()]
    staged = RK.double_images(df, [F.col("x"), -F.col("x")]).collect()
    assert [r["c0"] for r in staged] == one
    assert [r["c1"] for r in staged] == [None if i is None else -i for i in one]


def test_engineering_reads_its_rows_once(spark):
    seen, told = _told(spark)
    df = spark.range(100).select("id", F.lit(1).alias("loan_status_binary"), told(F.when(F.col("id") != 5, F.col("id").cast("double"))).alias("income"),
                                 F.when(F.col("id") > 2, "a").alias("purpose"))
    rows = EN.engineer_features(df).collect()
    assert seen.value == 100
    assert {r["income"] for r in rows if r["id"] == 5} == {50.0} and {r["purpose"] for r in rows} == {"a"}
