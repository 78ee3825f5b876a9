"""Feature engineering and imputation (FE1-FE8).

Column presence is dynamic: each step acts only if its columns exist. Imputation statistics come
from bucket and value counts (two values per column at most are collected) and are applied as literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from riskspark.functions.exprs import emp_length_years, first_number, months_between_truncated, parse_month_year
from riskspark.operators import ranks
from riskspark.session import materialize


def engineer_dates(df: DataFrame, issue: str = "issue_d", earliest: str = "earliest_cr_line") -> DataFrame:
    """FE1-FE3: parse both dates, drop rows missing either, add ``credit_hist_months``,
    drop the date columns. No-op unless both columns exist."""
    if issue not in df.columns or earliest not in df.columns:
        return df
    parsed = df.withColumn(issue, parse_month_year(issue)).withColumn(earliest, parse_month_year(earliest))
    kept = parsed.where(F.col(issue).isNotNull() & F.col(earliest).isNotNull())
    return kept.withColumn("credit_hist_months", months_between_truncated(issue, earliest)).drop(issue, earliest)


def engineer_emp_length(df: DataFrame, col: str = "emp_length") -> DataFrame:
    """FE4: employment length text -> integer years."""
    return df.withColumn(col, emp_length_years(col)) if col in df.columns else df


def engineer_term(df: DataFrame, col: str = "term") -> DataFrame:
    """FE5: term text -> ``term_int`` (double); ``term`` dropped."""
    return df.withColumn("term_int", first_number(col)).drop(col) if col in df.columns else df


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in exclude]


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col, value, k): how often each text of each column occurs, without NULL."""
    wide = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(cols)])
    long = wide.unpivot([], [f"c{i}" for i in range(len(cols))], "col", "value").where("value is not null")
    return long.groupBy("col", "value").agg(F.count(F.lit(1)).alias("k"))


def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Interpolated medians by radix selection: a few rounds of bucket counts for all columns at once, none of
    which shuffles more than columns x buckets; at most two values of a column are collected."""
    return ranks.medians(df, {c: F.col(f"`{c}`") for c in cols})


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """The most frequent text of each column (ties: the smallest), from value counts."""
    if not cols:
        return {}
    best = F.min_by("value", F.struct(-F.col("k"), F.col("value"))).alias("v")
    return {cols[int(r["col"][1:])]: r["v"] for r in _long(df, cols).groupBy("col").agg(best).collect()}


def imputation_values(
    df: DataFrame, exclude: Sequence[str] = (), median_method: str = "exact", accuracy: int = 10000
) -> dict:
    """FE6/FE7 statistics: median of every numeric column with gaps (all-NULL -> 0) and the mode
    of every string column (ties -> smallest; all-NULL -> left untouched).

    One aggregation counts gaps; medians come from rounds of bucket counts, modes from value counts, all
    pre-aggregated before their shuffle; at most two values of a column reach the driver. With
    ``median_method='approx'`` medians are ``percentile_approx``."""
    nums, strs = numeric_columns(df, exclude), string_columns(df, exclude)
    values: dict = {}
    if nums:
        gaps = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(f"g_{i}") for i, c in enumerate(nums)]).first()
        gappy = [c for i, c in enumerate(nums) if gaps[f"g_{i}"] > 0]
        if median_method == "exact":
            med = exact_medians(df, gappy)
        else:
            def x(c: str):
                return F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))

            row = df.agg(F.lit(0).alias("_"), *[F.percentile_approx(x(c), 0.5, accuracy).alias(f"m_{i}") for i, c in enumerate(gappy)]).first()
            med = {c: row[f"m_{i}"] for i, c in enumerate(gappy) if row[f"m_{i}"] is not None}
        # filling a column without gaps is a no-op (and keeps its type)
        values |= {c: float(med.get(c, 0.0)) for c in gappy}
    return values | modes(df, strs)


def impute(df: DataFrame, values: dict) -> DataFrame:
    """Fill NULLs (and NaN in numeric columns) with the given per-column values."""
    if not values:
        return df
    num_fill = {c: v for c, v in values.items() if not isinstance(v, str)}
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in num_fill:
            v = num_fill[f.name]
            if f.dataType.typeName() in ("double", "float"):
                c = F.when(c.isNull() | F.isnan(c), F.lit(v)).otherwise(c)
            elif float(v).is_integer():
                c = F.coalesce(c, F.lit(v).cast(f.dataType))
            else:  # a column with gaps is floating point in the reference: keep the exact median
                c = F.coalesce(c.cast("double"), F.lit(v))
        elif f.name in values:
            c = F.coalesce(c, F.lit(values[f.name]))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def engineer_features(
    df: DataFrame,
    key: str = "id",
    target: str = "loan_status_binary",
    fit_df: DataFrame | None = None,
    median_method: str = "exact",
) -> DataFrame:
    """FE8: FE1-FE5 then median/mode imputation. Statistics come from ``fit_df`` after the same
    engineering when given (e.g. train rows only), else from ``df`` itself (K2). The engineered rows are
    written once: each statistic and the imputation read them, and dates and texts are parsed once a row."""
    def shape(d: DataFrame) -> DataFrame:
        return d.transform(engineer_dates).transform(engineer_emp_length).transform(engineer_term)

    out = materialize(shape(df), "shaped")
    stats_src = materialize(shape(fit_df), "shaped-fit") if fit_df is not None else out
    values = imputation_values(stats_src, exclude=(key, target), median_method=median_method)
    return impute(out, values)
