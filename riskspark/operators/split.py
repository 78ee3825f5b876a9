"""Deterministic stratified train / validation / test split (SPL1, SPL2).

Rows are ordered inside each class by ``md5(key || '|' || seed)``; the first
``round(n_y * test_size)`` rows of class y are test, the next ``round((n_y - test_y) * val_size)``
validation, the rest train. The rank is computed in two levels so no window ever holds a whole
class: counts per (class, hash prefix) give offsets, a table of one row for each prefix that is broadcast, then
``row_number`` runs inside each (class, prefix) group. The length of the prefix follows from the class counts, so that a group
holds about ``RANK_ROWS`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Rows that one task ranks.
RANK_ROWS = 100_000


def split_hash(key: str, seed: int) -> F.Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def stratified_split(
    df: DataFrame,
    target_col: str = "loan_status_binary",
    key: str = "id",
    test_size: float = 0.20,
    val_size: float = 0.25,
    random_state: int = 42,
    split_col: str = "split",
) -> DataFrame:
    """SPL1: add ``split`` in {'train', 'val', 'test'}, class shares kept. Ranks are taken within a class
    and a hash prefix, whose length follows from the largest class so that a task orders about
    ``RANK_ROWS`` rows."""
    h = split_hash(key, random_state)
    largest = df.groupBy(target_col).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    prefix_len = 1
    while largest > RANK_ROWS * 16 ** prefix_len:
        prefix_len += 1
    tagged = df.withColumn("_h", h).withColumn("_p", F.substring("_h", 1, prefix_len))
    counts = tagged.groupBy(target_col, "_p").agg(F.count(F.lit(1)).alias("_cnt"))
    w_cls = Window.partitionBy(target_col)
    w_before = Window.partitionBy(target_col).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        target_col,
        "_p",
        F.coalesce(F.sum("_cnt").over(w_before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(w_cls).alias("_n"),
    )
    rank = F.row_number().over(Window.partitionBy(target_col, "_p").orderBy("_h", key)) + F.col("_off")
    n_test = F.bround(F.col("_n") * F.lit(float(test_size)), 0)
    n_val = F.bround((F.col("_n") - n_test) * F.lit(float(val_size)), 0)
    ranked = tagged.join(offsets, [target_col, "_p"]).withColumn("_r", rank)
    split = F.when(F.col("_r") <= n_test, "test").when(F.col("_r") <= n_test + n_val, "val").otherwise("train")
    return ranked.withColumn(split_col, split).drop("_h", "_p", "_off", "_n", "_r")


def split_report(df: DataFrame, split_col: str = "split") -> DataFrame:
    """SPL2: rows and share per part."""
    counts = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy()))
