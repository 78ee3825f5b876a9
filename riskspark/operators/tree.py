"""Supervised numeric binning with a one-feature CART (BIN1, BIN5).

All numeric features are fitted together. The data are reduced once to a histogram
(feature, value, n, good) — partial aggregation absorbs low-cardinality columns — with running
sums in value order. The weighted Gini decrease ``(gL²+bL²)/nL + (gR²+bR²)/nR - (G²+B²)/n`` is convex in the
running sums (n, good) at the cut, so among consecutive values it is largest at a vertex of their convex hull, whatever
the leaf. Each stretch of values is therefore reduced, once, to the points on its hull, and a round reads:

1. the hulls of all stretches that lie, with all their cuts legal, within one leaf (leaves are literals: upper end,
   running sums before and at the end; the sums at a cut come back with it, so no leaf is ever summed again);
2. the values themselves of the few stretches that a leaf's end or the least leaf size divides, two for a leaf at most.

The best candidate per (feature, leaf) is collected from both, a maximum that is pre-aggregated. Best-first growth
(``max_leaves``, BIN1) splits the best leaf of each feature, level-wise growth (``max_depth`` alone, BIN5) splits
every leaf; with both limits growth is best-first among the leaves that are not yet at the depth limit. Cuts are
midpoints. Plans are a table plus one projection: lineage does not grow with the number of rounds.

The hulls are the one step that built-in functions cannot express: they are taken in Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators.cumulative import BLOCK_ROWS, running_totals
from riskspark.session import materialize

#: Values of a stretch that is reduced to its hull, at most.
STRETCH = 4096
_HULL = ("feature string, value double, next_value double, cum_n bigint, cum_good bigint, low bigint, high bigint")


def value_histogram(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, value, n, good) over non-NULL, non-NaN values of every feature."""
    wide = df.select(F.col(target).cast("long").alias("_y"), *[F.col(f).cast("double").alias(f) for f in features])
    long = wide.unpivot("_y", list(features), "feature", "value")
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("good"))


@dataclass
class _Leaf:
    """A leaf of one feature: values up to ``hi``, running sums before it and at its end."""

    hi: float
    before_n: int
    before_good: int
    end_n: int
    end_good: int
    depth: int = 0


def hull_points(x: np.ndarray, y: np.ndarray, stretch: np.ndarray) -> np.ndarray:
    """Which points (x rising within a stretch) lie on the convex hull of their stretch, points on its edges included.

    A point strictly above (below) the line between its neighbours is not on the lower (upper) hull; all such points
    are dropped at once, until none is left."""
    keep = np.zeros(len(x), bool)
    x, y = x.astype(np.float64), y.astype(np.float64)
    for sign in (1.0, -1.0):
        at = np.arange(len(x))
        while len(at) > 2:
            px, py, ps = x[at], sign * y[at], stretch[at]
            dx, dy = px[1:] - px[:-1], py[1:] - py[:-1]
            turn = dx[:-1] * dy[1:] - dy[:-1] * dx[1:]  # below 0: the point lies above the line of its neighbours
            limit = 1e-12 * (np.abs(dx[:-1] * dy[1:]) + np.abs(dy[:-1] * dx[1:]))
            inner = np.zeros(len(at), bool)
            inner[1:-1] = (turn < -limit) & (ps[2:] == ps[:-2])
            if not inner.any():
                break
            at = at[~inner]
        keep[at] = True
    return keep


def _hulls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hull points of the stretches of each batch, with the running rows at both ends of their stretch."""
    for rows in batches:
        if not len(rows):
            continue
        block, feature = rows["block"].to_numpy(), rows["feature"].to_numpy()
        n, good = rows["cum_n"].to_numpy(), rows["cum_good"].to_numpy()
        # a stretch that two batches or files divide is two
        new = np.concatenate([[True], (block[1:] != block[:-1]) | (feature[1:] != feature[:-1]) | (n[1:] <= n[:-1])])
        stretch = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(rows)) - 1
        on = hull_points(n - n[begin][stretch], good - good[begin][stretch], stretch)
        out = rows.loc[on, ["feature", "value", "next_value", "cum_n", "cum_good"]]
        yield out.assign(low=n[begin][stretch[on]], high=n[end][stretch[on]])


def _known(leaves: dict[str, list[_Leaf]], min_leaf: dict[str, int], max_depth: int | None) -> Column:
    """The leaves of each row's feature as literals; ``first`` and ``last`` are the running rows of the legal cuts."""
    def literal(f: str, leaf: _Leaf) -> Column:
        whole = lambda x: F.lit(x).cast("bigint")
        return F.struct(F.lit(leaf.hi).alias("hi"), whole(leaf.before_n).alias("on"), F.lit(float(leaf.before_good)).alias("og"),
                        whole(leaf.end_n).alias("end"), F.lit(float(leaf.end_good - leaf.before_good)).alias("tg"), whole(min_leaf[f]).alias("m"),
                        whole(leaf.before_n + min_leaf[f]).alias("first"), whole(leaf.end_n - min_leaf[f]).alias("last"),
                        F.lit(max_depth is None or leaf.depth < max_depth).alias("open"))

    known = F.create_map(*[e for f, ls in leaves.items() for e in (F.lit(f), F.array(*[literal(f, x) for x in ls]))])
    return F.element_at(known, F.col("feature"))


def _leaves_of(rows: DataFrame, known: Column) -> DataFrame:
    """``rows`` with the struct ``s`` of the open leaf that each value lies in."""
    mine = F.filter(known, lambda x: F.col("value") <= x["hi"])
    return rows.select("*", F.get(mine, F.lit(0)).alias("s")).where("s.open")


def _best() -> Column:
    return F.max_by(F.struct("value", "next_value", "gain", "cum_n", "cum_good"), F.struct(F.col("gain"), -F.col("value"))).alias("best")


def _gains(rows: DataFrame) -> DataFrame:
    """Every legal split position of ``rows`` (with their leaf ``s``) and its gain. The last value of a leaf is never legal
    (its right side is empty), so the feature-level next value is exact."""
    # Staged projections keep every expression small (the expanded gain formula would otherwise
    # exceed the code-generation size limit and run interpreted).
    s1 = rows.select(
        "feature", "value", "next_value", "cum_n", "cum_good", F.col("s.hi").alias("leaf"), F.col("s.m").alias("m"),
        (F.col("cum_n") - F.col("s.on")).cast("double").alias("nl"), (F.col("cum_good") - F.col("s.og")).alias("gl"),
        (F.col("s.end") - F.col("s.on")).cast("double").alias("tn"), F.col("s.tg").alias("tg"),
    ).where("tg > 0 and tg < tn and nl >= m and tn - nl >= m")
    s2 = s1.select("*", (F.col("nl") - F.col("gl")).alias("bl"), (F.col("tn") - F.col("nl")).alias("nr"),
                   (F.col("tg") - F.col("gl")).alias("gr"), (F.col("tn") - F.col("tg")).alias("tb"))
    s3 = s2.select("*", (F.col("nr") - F.col("gr")).alias("br"))
    gain = ((F.col("gl") * F.col("gl") + F.col("bl") * F.col("bl")) / F.col("nl")
            + (F.col("gr") * F.col("gr") + F.col("br") * F.col("br")) / F.col("nr")
            - (F.col("tg") * F.col("tg") + F.col("tb") * F.col("tb")) / F.col("tn"))
    return s3.select("feature", "leaf", "value", "next_value", "cum_n", "cum_good", F.greatest(gain, F.lit(0.0)).alias("gain"))


def best_splits(hist: DataFrame, hulls: DataFrame, leaves: dict[str, list[_Leaf]], min_leaf: dict[str, int],
                max_depth: int | None) -> tuple[dict[tuple[str, float], dict], list[tuple]]:
    """The best split of each (feature, leaf), and the stretches ``(feature, low, high)`` whose values were read for it."""
    known = _known(leaves, min_leaf, max_depth)
    tagged = _leaves_of(hulls, known).where("low >= s.first and high <= s.last")
    got = _gains(tagged).groupBy("feature", "leaf").agg(_best()).select("feature", "leaf", "best", F.lit(None).cast("bigint").alias("low"), F.lit(None).cast("bigint").alias("high"))
    low, high = F.col("low"), F.col("high")
    divided = F.exists(known, lambda x: x["open"] & (x["first"] <= x["last"]) & (low <= x["last"]) & (high >= x["first"]) & ~((low >= x["first"]) & (high <= x["last"])))
    # the first point of a stretch is always on its hull
    parts_of = hulls.where("cum_n = low").where(divided).select(
        "feature", F.lit(None).cast("double").alias("leaf"), F.lit(None).cast(got.schema["best"].dataType).alias("best"), "low", "high")
    both = got.unionByName(parts_of).collect()
    found = [r for r in both if r["best"] is not None]
    parts = sorted((r["feature"], r["low"], r["high"]) for r in both if r["best"] is None)
    if parts:
        inside = F.lit(False)
        for f, low, high in parts:
            inside = inside | ((F.col("feature") == f) & F.col("cum_n").between(low, high))
        raw = _leaves_of(hist.where(inside).select("feature", "value", "next_value", "cum_n", "cum_good"), known)
        found += _gains(raw).groupBy("feature", "leaf").agg(_best()).collect()
    best: dict[tuple[str, float], dict] = {}
    for r in found:
        at, b = (r["feature"], r["leaf"]), r["best"]
        if at not in best or (b["gain"], -b["value"]) > (best[at]["gain"], -best[at]["value"]):
            best[at] = b
    return best, parts


def _midpoint(a: float, b: float) -> float:
    t = a / 2.0 + b / 2.0
    if t == b or math.isinf(t):
        t = a
    return t


def tree_cuts(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    max_leaves: int | None = 6,
    min_samples_leaf: float | int = 0.05,
    max_depth: int | None = None,
    block_rows: int = BLOCK_ROWS,
    stretch: int = STRETCH,
) -> dict[str, list[float]]:
    """BIN1 (``max_leaves``, best-first) or BIN5 (``max_depth`` with ``max_leaves=None``, level-wise) cut
    points per feature, sorted; with both limits best-first growth within the depth limit. A float
    ``min_samples_leaf`` < 1 is a fraction of the feature's rows (rounded up), an int an absolute
    count. Constant features (BIN2) get no cuts."""
    features = list(features)
    if not features:
        return {}
    if max_leaves is None and max_depth is None:
        raise ValueError("tree_cuts needs max_leaves or max_depth")
    # The running sums (bounded by distinct values, far smaller than the rows) and the hulls are written once to
    # the shared checkpoint folder: every round plans against a short lineage.
    run = running_totals(value_histogram(df, features, target).withColumn("one", F.lit(1).cast("bigint")), "value", ["n", "good", "one"],
                         ["feature"], with_next=True, block_rows=block_rows)
    hist = materialize(run.withColumn("block", F.floor((F.col("cum_one") - 1) / stretch)).drop("one", "cum_one", "tot_one"), "tree-running-sums")
    totals = {r["feature"]: (r["n"], r["g"]) for r in hist.groupBy("feature").agg(
        F.max("tot_n").alias("n"), F.max("tot_good").alias("g")).collect()}
    cuttable = hist.where("next_value is not null").select("feature", "value", "next_value", "cum_n", "cum_good", "block")
    hulls = materialize(cuttable.mapInPandas(_hulls, _HULL), "tree-hulls")
    fraction = isinstance(min_samples_leaf, float) and min_samples_leaf < 1.0
    min_leaf = {f: max(1, math.ceil(min_samples_leaf * n)) if fraction else int(min_samples_leaf) for f, (n, _) in totals.items()}
    leaves = {f: [_Leaf(math.inf, 0, 0, n, g)] for f, (n, g) in totals.items()}
    rounds = max_depth if max_leaves is None else max_leaves - 1
    for _ in range(rounds if leaves else 0):
        found, _ = best_splits(cuttable, hulls, leaves, min_leaf, max_depth)
        if max_leaves is not None:  # the best leaf of each feature; of equal gains the smallest value
            top: dict[str, tuple] = {}
            for at, b in found.items():
                if at[0] not in top or (b["gain"], -b["value"]) > (top[at[0]][1]["gain"], -top[at[0]][1]["value"]):
                    top[at[0]] = (at, b)
            found = dict(top.values())
        if not found:
            break
        for (f, hi), b in found.items():
            at = leaves[f]
            i = next(k for k, leaf in enumerate(at) if leaf.hi == hi)
            old, cut = at[i], _midpoint(b["value"], b["next_value"])
            at[i:i + 1] = [_Leaf(cut, old.before_n, old.before_good, b["cum_n"], b["cum_good"], old.depth + 1),
                           _Leaf(old.hi, b["cum_n"], b["cum_good"], old.end_n, old.end_good, old.depth + 1)]
    return {f: [leaf.hi for leaf in leaves.get(f, [])[:-1]] for f in features}
