"""Scorecard scaling, points and risk tables (SCL1-SCL6, MST1-MST4)."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.exprs import percent_text, right_closed_bin, round_half_even
from riskspark.operators import ranks
from riskspark.operators.woe import transform_woe


@dataclass(frozen=True)
class Scaling:
    """SCL1: factor = PDO / ln 2, offset = base_score - factor * ln(base_odds)."""

    pdo: float = 50.0
    base_score: float = 600.0
    base_odds: float = 50.0

    @property
    def factor(self) -> float:
        return self.pdo / math.log(2.0)

    @property
    def offset(self) -> float:
        return self.base_score - self.factor * math.log(self.base_odds)


def logit_expr(intercept: float, coefficients: Mapping[str, float]) -> Column:
    """SCL2: intercept + sum(beta_i * WoE_i), literal coefficients over WoE columns."""
    expr = F.lit(float(intercept))
    for f, b in coefficients.items():
        expr = expr + F.lit(float(b)) * F.col(f)
    return expr


def score_expr(logit: str | Column, scaling: Scaling = Scaling(), truncate: bool = False) -> Column:
    """SCL3: half-even round(offset + factor * logit) as INT; SCL4 (``truncate``): toward zero."""
    x = F.col(logit) if isinstance(logit, str) else logit
    raw = F.lit(scaling.offset) + F.lit(scaling.factor) * x
    return (raw if truncate else F.bround(raw, 0)).cast("int")


def _bin_label() -> Column:
    def num(c: str) -> Column:
        v = F.col(c)
        return F.when(v == F.lit(math.inf), F.lit("inf")).when(v == F.lit(-math.inf), F.lit("-inf")).otherwise(v.cast("string"))

    return F.when(F.col("kind") == "num", F.concat(F.lit("("), num("lo"), F.lit(", "), num("hi"), F.lit("]"))).otherwise(F.col("category"))


def points_bins(bin_table: DataFrame, coefficients: Mapping[str, float], scaling: Scaling = Scaling()) -> DataFrame:
    """Bin table of the model features with ``coefficient`` and ``points`` = round(factor x beta x WoE)."""
    spark = bin_table.sparkSession
    coef = spark.createDataFrame([(f, float(b)) for f, b in coefficients.items()], "feature string, coefficient double")
    j = bin_table.where("valid").join(F.broadcast(coef), "feature")
    return j.withColumn("points", F.bround(F.lit(scaling.factor) * F.col("coefficient") * F.col("woe"), 0))


def points_table(
    bin_table: DataFrame, intercept: float, coefficients: Mapping[str, float], scaling: Scaling = Scaling()
) -> DataFrame:
    """SCL5: Feature, Bin, WoE (4 dp), Coefficient (4 dp), Points; the first row holds the base
    points round(offset + factor x intercept) with the unrounded intercept."""
    spark = bin_table.sparkSession
    base_pts = float(round(scaling.offset + scaling.factor * intercept))
    base = spark.createDataFrame(
        [(0, "Base Points (Intercept)", "All", None, float(intercept), base_pts, None, None)],
        "row_kind int, Feature string, Bin string, WoE double, Coefficient double, Points double, bin_id int, category string",
    )
    rows = points_bins(bin_table, coefficients, scaling).select(
        F.lit(1).alias("row_kind"),
        F.col("feature").alias("Feature"),
        _bin_label().alias("Bin"),
        round_half_even("woe", 4).alias("WoE"),
        round_half_even("coefficient", 4).alias("Coefficient"),
        F.col("points").alias("Points"),
        "bin_id",
        "category",
    )
    return base.unionByName(rows).withColumn("Points", F.col("Points").cast("long"))


def additive_scores(
    df: DataFrame,
    bin_table: DataFrame,
    intercept: float,
    coefficients: Mapping[str, float],
    scaling: Scaling = Scaling(),
    keep: tuple[str, ...] = ("id",),
) -> DataFrame:
    """SCL6: base points + sum of each feature's bin points (rounded per bin), looked up as in ``transform_woe``."""
    pts = points_bins(bin_table, coefficients, scaling).drop("woe").withColumnRenamed("points", "woe")
    per = transform_woe(df, pts, keep=list(keep), features=list(coefficients))
    base = float(round(scaling.offset + scaling.factor * intercept))
    total = F.lit(base)
    for f in coefficients:
        total = total + F.col(f)
    return per.select(*keep, total.cast("int").alias("score"))


# ---- risk tables ---------------------------------------------------------------------------

def master_scale(
    scored: DataFrame,
    score: str = "score",
    pd: str = "pd",
    min_score: int = 300,
    max_score: int = 900,
    bin_width: int = 50,
) -> DataFrame:
    """MST1: bands (min, min+w], ..., volume, mean score (1 dp), mean PD; empty bands dropped;
    volume share over banded rows only; scores <= min or beyond the last edge fall out."""
    edges = list(range(min_score, max_score + bin_width, bin_width))
    s = F.col(score)
    band = F.when((s > F.lit(edges[0])) & (s <= F.lit(edges[-1])), F.ceil((s - F.lit(edges[0])) / F.lit(float(bin_width))))
    agg = scored.where(band.isNotNull()).groupBy(band.cast("int").alias("band")).agg(
        F.count(F.lit(1)).alias("Volume"), F.avg(s).alias("_avg"), F.avg(pd).alias("Calibrated_PD"))
    lo = F.lit(edges[0]) + (F.col("band") - 1) * F.lit(bin_width)
    share = F.col("Volume") / F.sum("Volume").over(Window.partitionBy())  # one row per band
    return agg.select(
        "band",
        F.concat(F.lit("("), lo.cast("string"), F.lit(", "), (lo + F.lit(bin_width)).cast("string"), F.lit("]")).alias("Score_Band"),
        "Volume",
        round_half_even("_avg", 1).alias("Average_Score"),
        "Calibrated_PD",
        percent_text(share).alias("Volume_Share"),
        percent_text("Calibrated_PD").alias("Calibrated_PD_Formatted"),
    )


def master_scale_legacy(
    scored: DataFrame, score: str = "score", pd: str = "pd", start: int = 300, stop: int = 900, width: int = 50
) -> DataFrame:
    """MST2: edges range(start, stop, width) (ends at 850), empty bands kept, mean score rounded
    to 0 dp, PD as percent text (NULL for an empty band)."""
    edges = list(range(start, stop, width))
    spark = scored.sparkSession
    s = F.col(score)
    band = F.when((s > F.lit(edges[0])) & (s <= F.lit(edges[-1])), F.ceil((s - F.lit(edges[0])) / F.lit(float(width))))
    agg = scored.where(band.isNotNull()).groupBy(band.cast("int").alias("band")).agg(
        F.avg(s).alias("_avg"), F.avg(pd).alias("_pd"), F.count(F.lit(1)).alias("Volume"))
    grid = spark.createDataFrame([(i + 1, f"({edges[i]}, {edges[i + 1]}]") for i in range(len(edges) - 1)], "band int, Score_Band string")
    return grid.join(agg, "band", "left").select(
        "band", "Score_Band",
        F.bround("_avg", 0).alias("Average_Score"),
        percent_text("_pd").alias("Calibrated_PD"),
        F.coalesce("Volume", F.lit(0)).alias("Volume"),
    )


def decile_edges(scored: DataFrame, score: str = "score", num_deciles: int = 10) -> list[float]:
    """Exact quantile edges (linear interpolation), duplicates dropped, as ``pd.qcut``, by radix selection of
    their ranks: any number of distinct scores, of any type."""
    return sorted(set(ranks.quantiles(scored, F.col(score), [i / num_deciles for i in range(num_deciles + 1)])))


def with_decile(scored: DataFrame, score: str = "score", num_deciles: int = 10, edges: list[float] | None = None) -> DataFrame:
    """Add ``decile`` (0 = lowest scores = riskiest): right-closed quantile bins, lowest included."""
    edges = decile_edges(scored, score, num_deciles) if edges is None else edges
    inner = edges[1:-1]
    return scored.withColumn("decile", right_closed_bin(F.col(score).cast("double"), inner) if inner else F.lit(0))


def decile_table(scored: DataFrame, score: str = "score", target: str = "target", num_deciles: int = 10) -> DataFrame:
    """MST3: per decile counts, bad rate, cumulative bad/good shares and their gap."""
    d = with_decile(scored, score, num_deciles)
    y = F.col(target)
    agg = d.groupBy("decile").agg(
        F.min(score).alias("min_score"), F.max(score).alias("max_score"), F.count(F.lit(1)).alias("volume"),
        F.sum(y).alias("good_count"), F.sum(1 - y).alias("bad_count"), F.avg(1 - y).alias("actual_bad_rate"))
    run = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # <= 10 rows
    every = Window.partitionBy()
    cb = F.coalesce(F.try_divide(F.sum("bad_count").over(run), F.sum("bad_count").over(every)), F.lit(0.0))
    cg = F.coalesce(F.try_divide(F.sum("good_count").over(run), F.sum("good_count").over(every)), F.lit(0.0))
    return agg.select("*", cb.alias("cum_bad_rate"), cg.alias("cum_good_rate")).withColumn(
        "ks_decile", F.abs(F.col("cum_bad_rate") - F.col("cum_good_rate")))


def decile_pd(scored: DataFrame, score: str = "score", target: str = "target", pd: str = "pd", num_deciles: int = 10) -> DataFrame:
    """MST4: decile volume, bad rate and mean PD (chart data)."""
    d = with_decile(scored, score, num_deciles)
    return d.groupBy("decile").agg(
        F.count(F.lit(1)).alias("volume"), (1.0 - F.avg(target)).alias("actual_bad_rate"), F.avg(pd).alias("avg_pd"))
