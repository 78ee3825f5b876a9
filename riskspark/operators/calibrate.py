"""Probability calibration (CAL1-CAL8): isotonic fit and reliability tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.exprs import clip, linspace, right_closed_bin
from riskspark.operators import isotonic
from riskspark.operators.isotonic import IsotonicFit


def fit_isotonic(df: DataFrame, x: str, y: str, weight: str | None = None) -> IsotonicFit:
    """CAL1: increasing isotonic regression of y on x (pool-adjacent-violators; equal x pooled)."""
    return isotonic.fit(df, x, y, weight)


def calibrated_good(
    df: DataFrame,
    model: IsotonicFit,
    x: str,
    out: str = "p_good",
    out_of_bounds: str = "clip",
    y_min: float = 0.0,
    y_max: float = 1.0,
) -> DataFrame:
    """CAL2/CAL4: calibrated P(good); linear interpolation between boundaries, clipped outside
    (``clip``) or NULL outside the fitted range (``nan``); result bounded to [y_min, y_max]."""
    res = model.values(df, x, "_iso")
    val = F.when(F.col("_iso").isNotNull(), clip(F.col("_iso"), y_min, y_max))
    if out_of_bounds == "nan":
        at = F.col(x).cast("double")
        val = F.when((at >= F.lit(model.low)) & (at <= F.lit(model.high)), val)
    return res.withColumn(out, val).drop("_iso")


def calibrated_pd(df: DataFrame, model: IsotonicFit, x: str, out: str = "calibrated_pd") -> DataFrame:
    """CAL3: PD = 1 - calibrated P(good)."""
    return calibrated_good(df, model, x, "_pg").withColumn(out, 1.0 - F.col("_pg")).drop("_pg")


def calibration_bins(df: DataFrame, label: str, prob: str, n_bins: int = 10) -> DataFrame:
    """CAL5: n equal bins on [0, 1] (right-closed, 0 included); empty bins kept with zero counts
    and NULL rates; probabilities outside [0, 1] fall out."""
    spark = df.sparkSession
    edges = linspace(0.0, 1.0, n_bins)
    p = F.col(prob).cast("double")
    b = F.when((p >= 0.0) & (p <= 1.0), right_closed_bin(p, edges[1:-1]))
    y = F.col(label).cast("long")
    agg = df.where(b.isNotNull()).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.sum(y).alias("good_count"), F.sum(1 - y).alias("bad_count"),
        F.avg(y).alias("actual_good_rate"), F.avg(p).alias("avg_pred_good_prob"))
    grid = spark.createDataFrame([(i, edges[i], edges[i + 1]) for i in range(n_bins)], "bin int, lo double, hi double")
    j = grid.join(agg, "bin", "left")
    return j.select(
        "bin", "lo", "hi",
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("good_count", F.lit(0)).alias("good_count"),
        F.coalesce("bad_count", F.lit(0)).alias("bad_count"),
        "actual_good_rate", "avg_pred_good_prob",
        (1.0 - F.col("actual_good_rate")).alias("actual_bad_rate"),
    )


def reliability_curve(df: DataFrame, label: str, probs: dict[str, str], n_bins: int = 10) -> DataFrame:
    """CAL6: per series and non-empty bin, (mean predicted, fraction positive); same edges as CAL5."""
    edges = linspace(0.0, 1.0, n_bins)
    inner = edges[1:-1]
    parts = []
    for name, c in probs.items():
        p = F.col(c).cast("double")
        parts.append(df.select(F.lit(name).alias("series"), right_closed_bin(p, inner).alias("bin"), p.alias("_p"),
                               F.col(label).cast("double").alias("_y")))
    u = parts[0]
    for q in parts[1:]:
        u = u.unionByName(q)
    return u.groupBy("series", "bin").agg(F.avg("_p").alias("mean_predicted"), F.avg("_y").alias("fraction_positive"))


def probability_slice(df: DataFrame, label: str, prob: str, lo: float = 0.38, hi: float = 0.41) -> DataFrame:
    """CAL7: outcome counts of rows with lo <= prob < hi."""
    p = F.col(prob)
    return df.where((p >= lo) & (p < hi)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def mean_comparison(df: DataFrame, label: str, raw_pd: str, calibrated_pd_col: str) -> DataFrame:
    """CAL8: mean raw PD, mean calibrated PD, actual bad rate (one aggregation)."""
    return df.agg(F.avg(raw_pd).alias("mean_raw_pd"), F.avg(calibrated_pd_col).alias("mean_calibrated_pd"),
                  (1.0 - F.avg(F.col(label).cast("double"))).alias("actual_bad_rate"))
