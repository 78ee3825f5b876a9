"""Exact order statistics by radix selection (medians, quantile edges, threshold samples).

A number is given an image: a 64-bit integer in the same order. Values of given ranks are found from the leading
bits on: a round counts, for all columns at once, how many values fall into each bucket of the next ``BITS`` bits
below the buckets found so far, and the running sums of these counts (at most 2 ** BITS of them under a bucket)
say in which one each rank lies. The counts are pre-aggregated, so a round shuffles columns x buckets, whatever the
rows hold: all values distinct, one value in most rows, or both."""

from __future__ import annotations

import struct
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.session import delete_table, materialize

#: Bits of a round; an image has 64.
BITS = 16
_LEAST_NORMAL, _LEAST = 2.0**-1022, 2.0**-1074
_INFINITE = 2047 << 52


def _usual(a: Column) -> Column:
    return F.when((a >= _LEAST_NORMAL) & (a < float("inf")), a)


def _near(usual: Column) -> Column:
    return F.floor(F.log2(usual))


def _power(e: Column) -> Column:
    return F.pow(F.lit(2.0), e)


def _exponent(usual: Column, near: Column, power: Column) -> Column:
    return near - F.when(power > usual, 1).otherwise(0) + F.when(power <= usual / 2, 1).otherwise(0)


def _image(x: Column, a: Column, usual: Column, e: Column, power: Column) -> Column:
    normal = F.shiftleft((e + 1023).cast("bigint"), 52) + ((usual / power - 1.0) * float(1 << 52)).cast("bigint")
    bits = (F.when(a == 0, F.lit(0).cast("bigint")).when(a == F.lit(float("inf")), F.lit(_INFINITE))
            .when(a < _LEAST_NORMAL, (a / _LEAST).cast("bigint")).otherwise(normal))
    return F.when(~F.isnan(x), F.when(x < 0, -bits).otherwise(bits))


def double_image(x: Column) -> Column:
    """Order-preserving integer of a double: its IEEE bits without the sign, negated for negative numbers (so both
    zeros are 0). NULL for NULL and NaN. The exponent is taken from a logarithm and set right by comparison."""
    a = F.abs(x)
    usual = _usual(a)
    near = _near(usual)
    e = _exponent(usual, near, _power(near))
    return _image(x, a, usual, e, _power(e))


def double_images(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """The images of doubles as columns ``c0``, ``c1``, ...: ``double_image`` in projections that name each part once. As
    one expression its logarithm and powers are repeated many times over, in code too long to be compiled."""
    n = range(len(columns))
    parts = df.select(*[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    for name, part in (("a", lambda c: F.abs(c("x"))), ("u", lambda c: _usual(c("a"))), ("n", lambda c: _near(c("u"))),
                       ("p", lambda c: _power(c("n"))), ("e", lambda c: _exponent(c("u"), c("n"), c("p"))), ("q", lambda c: _power(c("e"))),
                       ("c", lambda c: _image(c("x"), c("a"), c("u"), c("e"), c("q")))):
        parts = parts.select("*", *[part(lambda k, i=i: F.col(f"{k}{i}")).alias(f"{name}{i}") for i in n])
    return parts.select(*[f"c{i}" for i in n])


def double_of(image: int) -> float:
    value = struct.unpack("<d", struct.pack("<q", abs(image)))[0]
    return -value if image < 0 else value


def values_at(df: DataFrame, images: dict[str, Column], ranks: Callable[[Column], Column]) -> dict[str, dict[int, int]]:
    """For each named image (a bigint column; NULL is left out) the images at the ranks (from 0) that ``ranks`` gives as an
    array of the number of values. The images are written once, since every round reads them. Collected are columns x
    ranks rows a round."""
    names = list(images)
    if not names:
        return {}
    wide = materialize(df.select(*[c.cast("bigint").alias(f"c{i}") for i, c in enumerate(images.values())]), "rank-images")
    try:
        found = _search(wide, len(names), ranks)
    finally:
        delete_table(df.sparkSession, wide._written_to)
    out: dict[str, dict[int, int]] = {}
    for c, rank, image, _ in found:
        out.setdefault(names[int(c[1:])], {})[rank] = image
    return out


def _search(wide: DataFrame, n_columns: int, ranks: Callable[[Column], Column]) -> list[tuple[str, int, int | None, int]]:
    """(column, rank, image, values before it) for the images ``c0``, ``c1``, ... of ``wide``."""
    long = wide.unpivot([], [f"c{i}" for i in range(n_columns)], "col", "image").where("image is not null")
    found: list[tuple[str, int, int | None, int]] = []  # column, rank, bucket (None: all), values before it
    for shift in range(64 - BITS, -1, -BITS):
        rows = long
        if found:
            held: dict[str, set[int]] = {}
            for c, _, bucket, _ in found:
                held.setdefault(c, set()).add(bucket)
            inside = F.lit(False)
            for c, buckets in held.items():
                inside = inside | ((F.col("col") == c) & F.shiftright("image", shift + BITS).isin(sorted(buckets)))
            rows = long.where(inside)
        under = F.shiftright(F.col("bucket"), BITS) if found else F.lit(None).cast("bigint")
        counts = rows.groupBy("col", F.shiftright("image", shift).alias("bucket")).agg(F.count("*").alias("n")).withColumn("under", under)
        each = Window.partitionBy("col", "under")  # at most 2 ** BITS buckets
        run = counts.select("col", "under", "bucket", "n", F.sum("n").over(each.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
                            F.sum("n").over(each).alias("all"))
        if found:
            asked = wide.sparkSession.createDataFrame(found, "col string, rank bigint, under bigint, before bigint")
            at = run.join(F.broadcast(asked), ["col", "under"])
        else:
            at = run.withColumn("before", F.lit(0).cast("bigint")).withColumn("rank", F.explode(F.array_distinct(ranks(F.col("all")))))
        first = F.col("before") + F.col("upto") - F.col("n")
        at = at.where((F.col("rank") >= first) & (F.col("rank") < F.col("before") + F.col("upto")))
        found = [(r["col"], r["rank"], r["bucket"], r["first"]) for r in at.select("col", "rank", "bucket", first.alias("first")).collect()]
        if not found:
            break
    return found


def medians(df: DataFrame, columns: dict[str, Column]) -> dict[str, float]:
    """Interpolated medians of the columns with a value, without NULL and NaN."""
    n_ranks = lambda n: F.array(F.floor((n - 1) / 2), F.floor(n / 2))
    found = values_at(double_images(df, [*columns.values()]), {c: F.col(f"c{i}") for i, c in enumerate(columns)}, n_ranks) if columns else {}
    out = {}
    for c, at in found.items():
        v = [double_of(x) for x in at.values()]
        out[c] = sum(v) / len(v)
    return out


def quantiles(df: DataFrame, x: Column, probabilities: list[float]) -> list[float]:
    """Exact quantiles with linear interpolation between the neighbouring ranks; none without values."""
    def place(n: Column, p: float) -> Column:
        return F.lit(p) * (n - 1)

    def n_ranks(n: Column) -> Column:
        return F.array(*[f(place(n, p)).cast("bigint") for p in probabilities for f in (F.floor, F.ceil)])

    at = values_at(double_images(df, [x]), {"x": F.col("c0")}, n_ranks).get("x", {})
    if not at:
        return []
    number = x.cast("double")
    n = df.where(number.isNotNull() & ~F.isnan(number)).count()
    out = []
    for p in probabilities:
        want = p * (n - 1)
        low, high = int(want // 1), int(-(-want // 1))
        a, b = double_of(at[low]), double_of(at[high])
        out.append(a if low == high or a == b else (high - want) * a + (want - low) * b)
    return out


def threshold(df: DataFrame, image: Column, n: int) -> tuple[int, int] | None:
    """The n-th smallest image (n from 1) and how many are smaller; None if there are fewer than n."""
    at = values_at(df, {"x": image}, lambda total: F.array(F.lit(n - 1).cast("bigint"))).get("x")
    if not at:
        return None
    least = at[n - 1]
    return least, df.where(image < F.lit(least)).count()
