"""Logistic model on WoE features (MOD1-MOD4): Newton steps or Spark ML, both on the distinct WoE vectors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.session import checkpoint_dir, materialize


def balanced_weights(df: DataFrame, target: str, weight_col: str = "weight") -> DataFrame:
    """MOD2: class weight n / (2 n_class) as a column. Class counts come from one small
    aggregation (one row per class, broadcast)."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("_nc"))
    total = F.sum("_nc").over(Window.partitionBy())  # one row per class
    k = F.count(F.lit(1)).over(Window.partitionBy())
    w = counts.select(target, (total / (k * F.col("_nc"))).alias(weight_col))
    return df.join(F.broadcast(w), target)


def cells(df: DataFrame, features: Sequence[str], target: str, class_weight: str | None = "balanced") -> DataFrame:
    """``(features…, y, w)``: the distinct feature vectors of each class with the sum of their weights, written once.

    WoE columns take one value for each bin, so the cells are as many as combinations of bins occur, however many rows
    there are, and a fit on them has the same objective. The aggregation is partial before its shuffle."""
    y = F.col(target).cast("double")
    rows = df.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], y.alias("y")).where("y is not null")
    names = [f"x{i}" for i in range(len(features))]
    out = materialize(rows.groupBy(*names, "y").agg(F.count(F.lit(1)).alias("n")), "logistic-cells")
    if class_weight == "balanced":
        counts = {r["y"]: r["n"] for r in out.groupBy("y").agg(F.sum("n").alias("n")).collect()}  # one row for each class
        weight = F.lit(None).cast("double")
        for k, n in counts.items():
            weight = F.when(F.col("y") == k, F.lit(sum(counts.values()) / (len(counts) * n))).otherwise(weight)
    else:
        weight = F.lit(1.0)
    return out.select(*names, "y", (F.col("n") * weight).alias("w"))


def fit_newton(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    c_penalty: float = 1.0,
    max_iter: int = 50,
    class_weight: str | None = "balanced",
    tol: float = 1e-10,
) -> tuple[float, dict[str, float]]:
    """MOD1 by Newton steps: intercept and coefficients that minimise 0.5||beta||^2 + C * sum(w_i * loss_i).

    Each step is one aggregation over the cells for gradient and Hessian, (k + 1)(k + 4) / 2 + 1 sums that the driver solves; a
    step that does not lower the objective is halved. Features that are constant or copies of others are held by the penalty."""
    k = len(features)
    data = cells(df, features, target, class_weight)
    x = [F.lit(1.0), *[F.col(f"x{i}") for i in range(k)]]
    penalty = np.diag([0.0] + [1.0] * k)

    def at(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        logit = F.lit(float(beta[0]))
        for b, c in zip(beta[1:], x[1:]):
            logit = logit + F.lit(float(b)) * c
        rows = data.select("*", logit.alias("z"))
        # log(1 + exp(z)) - y z without overflow
        loss = F.greatest("z", F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("y") * F.col("z")
        rows = rows.select("*", (F.col("w") * loss).alias("l"), (1.0 / (1.0 + F.exp(-F.col("z")))).alias("p"))
        rows = rows.select("*", (F.col("w") * (F.col("p") - F.col("y"))).alias("g"), (F.col("w") * F.col("p") * (1.0 - F.col("p"))).alias("h"))
        sums = rows.agg(F.sum("l").alias("l"), *[F.sum(F.col("g") * c).alias(f"g{i}") for i, c in enumerate(x)],
                        *[F.sum(F.col("h") * x[i] * x[j]).alias(f"h{i}_{j}") for i in range(k + 1) for j in range(i, k + 1)]).first()
        gradient = np.array([sums[f"g{i}"] for i in range(k + 1)])
        hessian = np.array([[sums[f"h{min(i, j)}_{max(i, j)}"] for j in range(k + 1)] for i in range(k + 1)])
        value = c_penalty * sums["l"] + 0.5 * float(beta @ penalty @ beta)
        return value, c_penalty * gradient + penalty @ beta, c_penalty * hessian + penalty

    if data.select("y").distinct().count() < 2:
        raise ValueError(f"{target} needs rows of both classes")
    beta = np.zeros(k + 1)
    value, gradient, hessian = at(beta)
    for _ in range(max_iter):
        step = np.linalg.solve(hessian, gradient)
        if np.max(np.abs(step)) < tol:
            break
        scale = 1.0
        while True:
            tried = beta - scale * step
            new = at(tried)
            if new[0] <= value + 1e-12 * abs(value) or scale < 1e-6:
                break
            scale /= 2
        beta, (value, gradient, hessian) = tried, new
    return float(beta[0]), {f: float(b) for f, b in zip(features, beta[1:])}


def fit_logistic(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    c_penalty: float = 1.0,
    max_iter: int = 1000,
    class_weight: str | None = "balanced",
    tol: float = 1e-6,
) -> LogisticRegressionModel:
    """MOD1 as a Spark ML model: L2 logistic regression equal to the scikit-learn objective
    0.5||beta||^2 + C * sum(w_i * loss_i): Spark minimises mean(w_i * loss_i) + reg/2 ||beta||^2
    over sum(w_i), so reg = 1 / (C * sum(w_i)); intercept unpenalised, no standardisation. The optimiser's
    many passes run over the cells, not the rows."""
    checkpoint_dir(df.sparkSession)
    data = cells(df, features, target, class_weight)
    vec = VectorAssembler(inputCols=[f"x{i}" for i in range(len(features))], outputCol="_features").transform(data)
    w_sum = vec.agg(F.sum("w")).first()[0]
    lr = LogisticRegression(
        featuresCol="_features", labelCol="y", weightCol="w", maxIter=max_iter, tol=tol,
        regParam=1.0 / (c_penalty * w_sum), elasticNetParam=0.0, standardization=False, fitIntercept=True,
    )
    return lr.fit(vec)


def odds_table(spark: SparkSession, coefficients: dict[str, float]) -> DataFrame:
    """MOD3: Feature, Coefficient, Odds_Ratio ordered by coefficient descending."""
    df = spark.createDataFrame([*coefficients.items()], "Feature string, Coefficient double")
    return df.select("Feature", "Coefficient", F.exp("Coefficient").alias("Odds_Ratio")).orderBy(F.col("Coefficient").desc())


def coefficients_table(model: LogisticRegressionModel, features: Sequence[str]) -> DataFrame:
    """MOD3 of a Spark ML model."""
    return odds_table(SparkSession.getActiveSession(), model_parameters(model, features)[1])


def model_parameters(model: LogisticRegressionModel, features: Sequence[str]) -> tuple[float, dict[str, float]]:
    return float(model.intercept), {f: float(b) for f, b in zip(features, model.coefficients.toArray())}


def raw_good_probability(intercept: float, coefficients: dict[str, float]) -> F.Column:
    """MOD4: P(good) = 1 / (1 + exp(-logit)) with literal coefficients (no vector, no UDF)."""
    logit = F.lit(float(intercept))
    for f, b in coefficients.items():
        logit = logit + F.lit(float(b)) * F.col(f)
    return 1.0 / (1.0 + F.exp(-logit))
