"""Cumulative sums without single-task windows.

Two building blocks used across the library:

* ``threshold_sums`` — sums of rows at or above (or at or below) each of a bounded list of
  thresholds (a cutoff grid, bucket edges). One linear aggregation assigns every row to the
  gap between neighbouring thresholds (a balanced comparison tree, code-generated), so the
  shuffle carries at most ``len(thresholds) + 2`` groups per partition; the prefix/suffix sums
  then run over that tiny table. This replaces an O(rows x thresholds) theta join.
* ``running_totals`` — exact running sums over an unbounded ordered key (distinct predicted
  probabilities, histogram values): the rows are range-partitioned into blocks of bounded size,
  block totals become offsets, and the ordered window runs per block, so no task holds an
  unbounded group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.exprs import at_or_above_index, right_closed_bin
from riskspark.session import materialize

_IDX = "_t_idx"


def threshold_sums(
    df: DataFrame,
    value: str | Column,
    thresholds: Sequence[float],
    sums: Mapping[str, Column],
    side: str = "ge",
    rows_name: str = "rows",
) -> DataFrame:
    """For each threshold t: ``rows`` and every ``sums`` entry over rows with value >= t
    (``side='ge'``) or value <= t (``side='le'``), plus ``total_<name>`` over all rows.

    Returns columns ``t_idx, threshold, rows, <sums...>, total_rows, total_<sums...>``;
    exactly one row per distinct threshold, including thresholds no row reaches.
    """
    spark = df.sparkSession
    pts = sorted({float(t) for t in thresholds})
    if not pts:
        raise ValueError("threshold_sums needs at least one threshold")
    v = F.col(value) if isinstance(value, str) else value
    idx = at_or_above_index(v, pts) if side == "ge" else right_closed_bin(v, pts)
    names = [rows_name, *sums.keys()]
    per_gap = df.groupBy(idx.alias(_IDX)).agg(
        F.count(F.lit(1)).alias(rows_name), *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    grid = spark.createDataFrame([(i, p) for i, p in enumerate(pts)], f"{_IDX} int, threshold double")
    zero = grid.select(F.col(_IDX), F.col("threshold"), *[F.lit(0).alias(n) for n in names])
    filled = (
        per_gap.select(F.col(_IDX).cast("int").alias(_IDX), F.lit(None).cast("double").alias("threshold"), *names)
        .unionByName(zero)
        .groupBy(_IDX)
        .agg(F.max("threshold").alias("threshold"), *[F.sum(n).alias(n) for n in names])
    )
    everything = Window.partitionBy()  # <= len(thresholds) + 2 rows
    if side == "ge":
        run = Window.orderBy(F.col(_IDX).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        run = Window.orderBy(F.col(_IDX).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = filled.select(
        F.col(_IDX),
        F.col("threshold"),
        *[F.sum(n).over(run).alias(n) for n in names],
        *[F.sum(n).over(everything).alias(f"total_{n}") for n in names],
    )
    return out.where(F.col("threshold").isNotNull()).withColumnRenamed(_IDX, "t_idx")


# Rows of the running sums that one task orders.
BLOCK_ROWS = 1_000_000


def running_totals(
    df: DataFrame,
    order_col: str,
    sum_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    descending: bool = False,
    with_next: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Inclusive running sums ``cum_<c>`` of ``sum_cols`` ordered by ``order_col`` within
    ``group_cols``, and group totals ``tot_<c>``. ``df`` must be distinct on
    (group_cols, order_col), e.g. a histogram. With ``with_next``, also ``next_<order_col>``:
    the following value in order within the group (NULL for the last), of the same type. NULL keys
    come last in either direction; NaN counts as the largest number.

    The table is written once, range-partitioned by (group, key) into ceil(rows / block_rows)
    blocks, so a task orders a bounded number of rows whatever the size of a group; the totals of
    the blocks of a group (rows / block_rows of them) give the offsets. One plan at every size."""
    group_cols = list(group_cols)
    order = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_last()
    src = materialize(df, "running-input")
    blocks = max(1, -(-src.count() // block_rows))
    ranged = src.repartitionByRange(blocks, *[F.col(g) for g in group_cols], order)
    blk = materialize(ranged.withColumn("_blk", F.spark_partition_id()), "running-blocks")
    part = [*group_cols, "_blk"]
    # the first key of a block: minima and maxima leave NULL out and take NaN for the largest number, as the order does
    first = F.struct((F.max(order_col) if descending else F.min(order_col)).alias("v")).alias("_first")
    totals = blk.groupBy(*part).agg(*[F.sum(c).alias(f"_b_{c}") for c in sum_cols], *([first] if with_next else []))
    before = Window.partitionBy(*group_cols).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    following = Window.partitionBy(*group_cols).orderBy("_blk")
    offsets = totals.select(
        *part,
        *[F.coalesce(F.sum(f"_b_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        *[F.sum(f"_b_{c}").over(Window.partitionBy(*group_cols)).alias(f"tot_{c}") for c in sum_cols],
        *([F.lead("_first").over(following).alias("_next_first")] if with_next else []),
    )
    in_order = Window.partitionBy(*part).orderBy(order)
    local = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the offsets are joined after the sums, so that rows are ordered without them
    summed = blk.select("*", *[F.sum(c).over(local).alias(f"_sum_{c}") for c in sum_cols],
                        *([F.lead(F.struct(F.col(order_col).alias("v"))).over(in_order).alias("_next")] if with_next else []))
    return summed.join(offsets, part).select(
        *df.columns,
        *[(F.col(f"_sum_{c}") + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in sum_cols],
        *[F.col(f"tot_{c}") for c in sum_cols],
        *([F.coalesce("_next", "_next_first")["v"].alias(f"next_{order_col}")] if with_next else []),
    )
