"""Discrimination and calibration metrics (EVL1-EVL6).

Discrimination works on a histogram of distinct predicted values (partial aggregation), cut into blocks of
bounded size along the values. A block's positives and negatives before it come from the sums of the blocks, so
running sums, pairs won and the best gap are found within each block and merged: no table is written, and no
task holds an unbounded number of distinct probabilities."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.exprs import at_or_above_index, double_array, linspace, search
from riskspark.operators.cumulative import BLOCK_ROWS

#: Blocks at most: one row of sums each.
MOST_BLOCKS = 10_000


def block_edges(df: DataFrame, prob: str, block_rows: int = BLOCK_ROWS) -> list[float]:
    """Values that cut the rows into blocks of about ``block_rows``, one approximate-quantile pass; none if all rows fit one
    block. At most ``MOST_BLOCKS`` blocks; a value is never divided."""
    blocks = min(MOST_BLOCKS, -(-df.count() // block_rows))
    if blocks <= 1:
        return []
    p = F.col(prob).cast("double")
    found = df.agg(F.percentile_approx(F.when(~F.isnan(p), p), [i / blocks for i in range(1, blocks)], 10 * max(1000, blocks)).alias("q")).first()["q"]
    return sorted(set(found or []))


def roc_points(df: DataFrame, label: str = "target", prob: str = "prob", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """EVL1: one row per distinct threshold (descending): tp, fp (rows with prob >= threshold),
    tpr, fpr, and the positives/negatives exactly at the threshold."""
    hist = df.groupBy(F.col(prob).cast("double").alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg"))
    return from_histogram(hist, block_edges(df, prob, block_rows))


def from_histogram(hist: DataFrame, edges: list[float] | None = None) -> DataFrame:
    """ROC points of a histogram ``(threshold, pos, neg)``, in the blocks that ``edges`` cut."""
    edges = block_edges(hist, "threshold") if edges is None else edges
    rows = hist.withColumn("block", search(double_array(edges), len(edges), F.col("threshold")))
    sums = rows.groupBy("block").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    above = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)  # <= MOST_BLOCKS rows
    every = Window.partitionBy()
    before = sums.select("block", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"before_{c}") for c in "pn"],
                         F.sum("p").over(every).alias("tot_pos"), F.sum("n").over(every).alias("tot_neg"))
    inside = Window.partitionBy("block").orderBy(F.col("threshold").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    run = rows.select("block", "threshold", "pos", "neg", F.sum("pos").over(inside).alias("cum_pos"), F.sum("neg").over(inside).alias("cum_neg"))
    run = run.join(F.broadcast(before), "block")
    tp, fp = F.col("before_p") + F.col("cum_pos"), F.col("before_n") + F.col("cum_neg")
    return run.select(
        "threshold", "pos", "neg", tp.alias("tp"), fp.alias("fp"),
        F.try_divide(tp, F.col("tot_pos")).alias("tpr"), F.try_divide(fp, F.col("tot_neg")).alias("fpr"), "tot_pos", "tot_neg")


def discrimination(df: DataFrame, label: str = "target", prob: str = "prob") -> DataFrame:
    """EVL2-EVL4: AUC (ties count half), Gini = 2 AUC - 1, KS = max(tpr - fpr) and its threshold
    (first maximum = highest threshold; no positive gap -> 0 at +inf)."""
    return discrimination_of(roc_points(df, label, prob))


def discrimination_of(roc: DataFrame) -> DataFrame:
    """EVL2-EVL4 of ROC points. Products of counts are taken as doubles: as integers they overflow."""
    above = F.col("tp") - F.col("pos")
    diff = F.col("tpr") - F.col("fpr")
    agg = roc.agg(
        F.try_divide(F.sum(F.col("neg").cast("double") * (above + F.col("pos") / 2.0)),
                     F.max("tot_pos").cast("double") * F.max("tot_neg")).alias("auc"),
        F.max(diff).alias("_ks"),
        F.max_by(F.col("threshold"), F.struct(diff, F.col("threshold"))).alias("_thr"),
    )
    return agg.select(
        "auc",
        (2.0 * F.col("auc") - 1.0).alias("gini"),
        F.greatest(F.col("_ks"), F.lit(0.0)).alias("ks_stat"),
        F.when(F.col("_ks") > 0, F.col("_thr")).otherwise(F.lit(math.inf)).alias("ks_threshold"),
    )


def calibration_metrics(df: DataFrame, label: str = "target", prob: str = "prob") -> DataFrame:
    """EVL5: Brier score, predicted vs actual good and bad rates, absolute gap (one aggregation)."""
    y, p = F.col(label).cast("double"), F.col(prob)
    agg = df.agg(F.avg((p - y) * (p - y)).alias("brier_score"), F.avg(p).alias("pred_good_rate"), F.avg(y).alias("actual_good_rate"))
    return agg.select(
        "brier_score", "pred_good_rate", "actual_good_rate",
        (1.0 - F.col("pred_good_rate")).alias("pred_bad_rate"),
        (1.0 - F.col("actual_good_rate")).alias("actual_bad_rate"),
        F.abs(F.col("pred_good_rate") - F.col("actual_good_rate")).alias("mean_diff"),
    )


def score_distribution(df: DataFrame, score: str = "score", label: str = "target", bins: int = 30) -> DataFrame:
    """EVL6: equal-width histogram over the pooled range (NumPy edges: left-closed bins, the last
    closed), density per class = n / (N_class x bin width). Observed (class, bin) pairs."""
    r = df.agg(F.min(F.col(score).cast("double")).alias("a"), F.max(F.col(score).cast("double")).alias("b")).first()
    lo, hi = r["a"], r["b"]
    if lo is None:
        raise ValueError("empty input")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    edges = linspace(lo, hi, bins)
    b = at_or_above_index(F.col(score).cast("double"), edges[1:-1]) + 1
    counts = df.groupBy(F.col(label).alias("label"), b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    n_class = F.sum("count").over(Window.partitionBy("label"))  # over classes x bins rows
    lo_c = F.element_at(F.lit(edges[:-1]), F.col("bin") + 1)
    hi_c = F.element_at(F.lit(edges[1:]), F.col("bin") + 1)
    return counts.select(
        "label", "bin", lo_c.alias("lo"), hi_c.alias("hi"), "count",
        (F.col("count") / (n_class * (hi_c - lo_c))).alias("density"))
