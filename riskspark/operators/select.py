"""Feature selection by Information Value and collinearity (SEL1-SEL6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_by_iv(iv: DataFrame, min_iv: float = 0.02, max_iv: float = 0.55) -> DataFrame:
    """SEL1: features with min_iv <= IV <= max_iv, IV descending."""
    return iv.where((F.col("iv") >= min_iv) & (F.col("iv") <= max_iv)).orderBy(F.col("iv").desc(), "feature")


def iv_selection(iv: DataFrame, min_iv: float = 0.02, max_iv: float = 0.55, fallback: int = 5) -> DataFrame:
    """SEL1 + SEL2: the IV filter; when nothing passes, the top ``fallback`` features by IV."""
    passed = filter_by_iv(iv, min_iv, max_iv)
    ranked = iv.orderBy(F.col("iv").desc(), "feature").limit(fallback)
    # either branch is decided on the IV table: one row per feature
    return ranked if not passed.take(1) else passed


def correlation_matrix(df_woe: DataFrame, features: Sequence[str]):
    """|Pearson r| matrix of the given columns in one pass (Gramian aggregation in Spark ML);
    a k x k NumPy array, k = number of candidate features. A constant column gives NaN."""
    vec = VectorAssembler(inputCols=list(features), outputCol="_v", handleInvalid="keep").transform(df_woe.select(*features))
    return abs(Correlation.corr(vec, "_v", "pearson").head()[0].toArray())


def correlation_pairs(df_woe: DataFrame, features: Sequence[str]) -> DataFrame:
    """SEL3: |Pearson r| for every pair (a before b in the given order)."""
    feats = list(features)
    spark = df_woe.sparkSession
    if len(feats) < 2:
        return spark.createDataFrame([], "a string, b string, a_pos int, b_pos int, r double")
    m = correlation_matrix(df_woe, feats)
    rows = [(feats[i], feats[j], i, j, float(m[i][j])) for i in range(len(feats)) for j in range(i + 1, len(feats))]
    return spark.createDataFrame(rows, "a string, b string, a_pos int, b_pos int, r double")


def collinear_drops(pairs: DataFrame, iv: DataFrame, threshold: float = 0.70) -> DataFrame:
    """SEL4: for each pair with |r| > threshold (NaN never counts) drop the lower-IV feature;
    on equal IV the later one. Not greedy: a dropped feature still knocks others out."""
    ivs = iv.select("feature", "iv")
    hot = pairs.where((F.col("r") > threshold) & ~F.isnan("r"))
    j = (hot.join(F.broadcast(ivs.withColumnRenamed("feature", "a").withColumnRenamed("iv", "iv_a")), "a", "left")
            .join(F.broadcast(ivs.withColumnRenamed("feature", "b").withColumnRenamed("iv", "iv_b")), "b", "left"))
    iv_a, iv_b = F.coalesce("iv_a", F.lit(0.0)), F.coalesce("iv_b", F.lit(0.0))
    return j.select(F.when(iv_b > iv_a, F.col("a")).otherwise(F.col("b")).alias("feature")).distinct()


def select_features(
    df_woe: DataFrame, iv: DataFrame, min_iv: float = 0.02, max_iv: float = 0.55, corr_threshold: float = 0.70
) -> DataFrame:
    """SEL5: SEL1 -> SEL2 -> SEL4; (rank, feature, iv) of the kept features in IV order.

    Two jobs: the IV table (one row per feature) and one correlation pass over the data; the
    pair rule runs on the bounded k x k matrix."""
    spark = df_woe.sparkSession
    ranked = [(r["feature"], r["iv"]) for r in iv.orderBy(F.col("iv").desc(), "feature").collect()]
    chosen = [(f, v) for f, v in ranked if min_iv <= v <= max_iv] or ranked[:5]
    feats = [f for f, _ in chosen]
    ivs = dict(ranked)
    drops = set()
    if len(feats) > 1:
        m = correlation_matrix(df_woe, feats)
        for j in range(len(feats)):
            for i in range(j):
                r = m[i][j]
                if r == r and r > corr_threshold:  # NaN never counts
                    drops.add(feats[i] if ivs.get(feats[j], 0.0) > ivs.get(feats[i], 0.0) else feats[j])
    kept = [(k, f, ivs[f]) for k, f in enumerate(feats) if f not in drops]
    return spark.createDataFrame(kept, "rank int, feature string, iv double")


def top_iv_bands(iv: DataFrame, top_n: int = 15) -> DataFrame:
    """SEL6: top-n features by IV with the rule-of-thumb band."""
    band = (F.when(F.col("iv") > 0.55, "suspicious").when(F.col("iv") >= 0.30, "strong")
            .when(F.col("iv") >= 0.10, "medium").when(F.col("iv") >= 0.02, "weak").otherwise("unpredictive"))
    return iv.orderBy(F.col("iv").desc(), "feature").limit(top_n).select("feature", "iv", band.alias("strength"))
