"""Target definition and leakage removal (CLN1-CLN5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def map_target(
    df: DataFrame,
    target_col: str = "loan_status",
    target_mapping: Mapping[str, int] | None = None,
    binary_col_name: str = "loan_status_binary",
) -> DataFrame:
    """CLN1: status text -> 1 (good) / 0 (bad) by exact match; NULL or unmapped rows dropped."""
    if not target_mapping:
        raise ValueError("a mapping of status texts to 0 and 1 is needed")
    if target_col not in df.columns:
        raise KeyError(f"no status column named {target_col}; columns are {df.columns}")
    lookup = F.create_map(*chain.from_iterable((F.lit(k), F.lit(int(v))) for k, v in target_mapping.items()))
    mapped = F.try_element_at(lookup, F.col(target_col))
    return df.withColumn(binary_col_name, mapped).where(F.col(binary_col_name).isNotNull()).withColumn(
        binary_col_name, F.col(binary_col_name).cast("int")
    )


def target_distribution(df: DataFrame, binary_col_name: str = "loan_status_binary") -> DataFrame:
    """CLN2: count and share of each target value (a handful of rows)."""
    counts = df.groupBy(binary_col_name).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def unmapped_report(df: DataFrame, target_col: str, target_mapping: Mapping[str, int]) -> DataFrame:
    """CLN3: total, kept and dropped (NULL or unmapped status) rows in one aggregation."""
    known = F.col(target_col).isin(list(target_mapping.keys()))
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(known).alias("kept_rows"),
        F.count_if(~F.coalesce(known, F.lit(False))).alias("dropped_rows"),
    )


def drop_leakage_features(df: DataFrame, leakage_cols: Sequence[str], keep: Sequence[str] = ("id",)) -> DataFrame:
    """CLN4: drop the listed columns that exist; ``keep`` (the row key) survives (K23)."""
    present = [c for c in leakage_cols if c in df.columns and c not in keep]
    return df.drop(*present)


def clean_target_and_leakage(
    df: DataFrame,
    target_col: str,
    target_mapping: Mapping[str, int],
    leakage_cols: Sequence[str],
    binary_col_name: str = "loan_status_binary",
    keep: Sequence[str] = ("id",),
) -> DataFrame:
    """CLN5: CLN1 then CLN4."""
    return df.transform(lambda d: map_target(d, target_col, target_mapping, binary_col_name)).transform(
        lambda d: drop_leakage_features(d, leakage_cols, keep)
    )
