"""Binning, Weight of Evidence and Information Value (BIN2-BIN4, BIN6, WOE1-WOE10).

Fitting for all features is one job: each feature becomes a bin index (numeric: a comparison
tree over its cuts; categorical: the text, NULL -> 'nan'), the columns are unpivoted to
(feature, bin) and aggregated with partial aggregation, so the shuffle carries at most
features x bins (or categories) groups per partition. Totals per feature are pre-aggregated
over the written counts table and joined back.

The result is one **bin table** for every feature:
``feature, kind ('num'|'cat'), bin_id, lo, hi, category, total, good, bad, dist_good,
dist_bad, woe, iv, bad_rate, valid`` — ``valid`` is false when a feature's target has a single
class (WOE2: IV 0 and no mapping).
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from riskspark.functions.exprs import double_array, linspace, right_closed_bin, round_half_even
from riskspark.session import materialize

#: A category with at least 1 / FREQUENT of its feature's rows is a literal; other categories that are broadcast, at most.
FREQUENT, BROADCAST_CATEGORIES = 200, 100_000

BIN_TABLE_SCHEMA = (
    "feature string, kind string, bin_id int, lo double, hi double, category string, total long, good long, "
    "bad long, dist_good double, dist_bad double, woe double, iv double, bad_rate double, valid boolean"
)


def feature_kinds(df: DataFrame, features: Sequence[str]) -> dict[str, str]:
    """'num' for numeric/boolean, 'cat' for strings and other atomic types, 'unsupported' for
    nested types (WOE3: such a feature gets IV 0, decided from the schema)."""
    kinds = {}
    for f in df.schema.fields:
        if f.name not in features:
            continue
        t = f.dataType
        if isinstance(t, (NumericType, BooleanType)):
            kinds[f.name] = "num"
        elif isinstance(t, StringType) or t.typeName() in ("date", "timestamp", "timestamp_ntz", "binary"):
            kinds[f.name] = "cat"
        else:
            kinds[f.name] = "unsupported"
    return kinds


def category_text(c: str | Column) -> Column:
    """BIN3: category key; NULL becomes the text 'nan' (K22)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit("nan"))


def bin_counts(
    df: DataFrame,
    target: str,
    numeric_cuts: Mapping[str, Sequence[float]] | None = None,
    categorical: Sequence[str] = (),
) -> DataFrame:
    """(feature, kind, bin_id, category, total, good) for all features: one scan, one
    aggregation. Every feature becomes a text key (numeric: its bin index; categorical: the
    category, NULL -> 'nan'), the keys are unpivoted and counted with partial aggregation.
    Numeric NULL/NaN values fall in no bin (as ``pd.cut``)."""
    numeric_cuts = dict(numeric_cuts or {})
    categorical = list(categorical)
    if not numeric_cuts and not categorical:
        raise ValueError("no features to bin")
    keys = [right_closed_bin(F.col(f).cast("double"), cuts).cast("string").alias(f) for f, cuts in numeric_cuts.items()]
    keys += [category_text(f).alias(f) for f in categorical]
    wide = df.select(F.col(target).cast("long").alias("_y"), *keys)
    long = wide.unpivot("_y", [*numeric_cuts, *categorical], "feature", "key").where(F.col("key").isNotNull())
    counts = long.groupBy("feature", "key").agg(F.count(F.lit(1)).alias("total"), F.sum("_y").alias("good"))
    is_num = F.col("feature").isin(list(numeric_cuts)) if numeric_cuts else F.lit(False)
    return counts.select(
        "feature",
        F.when(is_num, F.lit("num")).otherwise(F.lit("cat")).alias("kind"),
        F.when(is_num, F.col("key").cast("int")).alias("bin_id"),
        F.when(~is_num, F.col("key")).alias("category"),
        "total",
        "good",
    )


def _numeric_grid(spark, numeric_cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """Every (feature, bin_id, lo, hi) of the numeric features, including empty bins."""
    rows = []
    for f, cuts in numeric_cuts.items():
        edges = [-math.inf, *sorted(float(c) for c in cuts), math.inf]
        for i in range(len(edges) - 1):
            rows.append((f, i, edges[i], edges[i + 1]))
    return spark.createDataFrame(rows, "feature string, bin_id int, lo double, hi double")


def woe_from_counts(
    counts: DataFrame,
    numeric_cuts: Mapping[str, Sequence[float]] | None = None,
    smoothing: str = "laplace",
    eps: float = 1e-4,
    keep_empty_numeric_bins: bool = True,
) -> DataFrame:
    """WOE1 / WOE5 / WOE6 on bin counts; returns the bin table.

    smoothing='laplace' (WOE1): dist = (n + 0.5) / (N + 0.5 k), k = number of bins
    smoothing='legacy'  (WOE5): dist = (n + 0.5) / N
    smoothing='eps'     (WOE6): rate = (n + eps) / N and woe = ln(bad share / good share)
    """
    spark = counts.sparkSession
    numeric_cuts = dict(numeric_cuts or {})
    if numeric_cuts and keep_empty_numeric_bins:
        counts = materialize(counts, "counted")  # both kinds are taken from it: the rows are read once
        grid = _numeric_grid(spark, numeric_cuts)
        num = counts.where(F.col("kind") == "num").drop("category", "kind")
        num = F.broadcast(grid).join(num, ["feature", "bin_id"], "left").select(
            "feature", F.lit("num").alias("kind"), "bin_id", "lo", "hi", F.lit(None).cast("string").alias("category"),
            F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("good", F.lit(0)).alias("good"),
        )
        cat = counts.where(F.col("kind") == "cat").select(
            "feature", "kind", "bin_id", F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
            "category", "total", "good")
        full = num.unionByName(cat)
    else:
        edges = {f: [-math.inf, *sorted(float(c) for c in cuts), math.inf] for f, cuts in numeric_cuts.items()}
        lo = F.lit(None).cast("double")
        hi = F.lit(None).cast("double")
        for f, e in edges.items():
            lo = F.when(F.col("feature") == f, F.element_at(F.lit(e[:-1]), F.col("bin_id") + 1)).otherwise(lo)
            hi = F.when(F.col("feature") == f, F.element_at(F.lit(e[1:]), F.col("bin_id") + 1)).otherwise(hi)
        full = counts.select("feature", "kind", "bin_id", lo.alias("lo"), hi.alias("hi"), "category", "total", "good")
    full = full.withColumn("bad", F.col("total") - F.col("good"))
    # The counts are written once (bins and categories, not rows); totals per feature are
    # pre-aggregated and joined back, so a feature of many categories stays spread over tasks.
    full = materialize(full, "bin-counts")
    totals = full.groupBy("feature").agg(F.sum("good").alias("_G"), F.sum("bad").alias("_B"), F.count(F.lit(1)).alias("_k"))
    j = full.join(F.broadcast(totals), "feature")  # one row per feature
    G, B, k = F.col("_G"), F.col("_B"), F.col("_k")
    good, bad = F.col("good"), F.col("bad")
    if smoothing == "laplace":
        dg, db = (good + 0.5) / (G + 0.5 * k), (bad + 0.5) / (B + 0.5 * k)
        woe = F.ln(dg / db)
    elif smoothing == "legacy":
        dg, db = (good + 0.5) / G, (bad + 0.5) / B
        woe = F.ln(dg / db)
    elif smoothing == "eps":
        dg, db = (good + F.lit(eps)) / G, (bad + F.lit(eps)) / B
        woe = F.ln(db / dg)
    else:
        raise ValueError(f"unknown smoothing {smoothing!r}")
    valid = (G > 0) & (B > 0)
    iv = (db - dg) * woe if smoothing == "eps" else (dg - db) * woe
    return j.select(
        "feature", "kind", "bin_id", "lo", "hi", "category", "total", "good", "bad",
        F.when(valid, dg).alias("dist_good"),
        F.when(valid, db).alias("dist_bad"),
        F.when(valid, woe).alias("woe"),
        F.when(valid, iv).alias("iv"),
        F.try_divide(bad.cast("double"), F.col("total")).alias("bad_rate"),
        valid.alias("valid"),
    )


def fit_woe(
    df: DataFrame,
    target: str,
    numeric_cuts: Mapping[str, Sequence[float]] | None = None,
    categorical: Sequence[str] = (),
    smoothing: str = "laplace",
) -> DataFrame:
    """WOE4 with given numeric cuts: the bin table of every feature in one job."""
    counts = bin_counts(df, target, numeric_cuts, categorical)
    return woe_from_counts(counts, numeric_cuts, smoothing)


def iv_summary(bin_table: DataFrame, all_features: Sequence[str] = ()) -> DataFrame:
    """WOE8 (+WOE2/WOE3): (feature, iv) ordered by IV desc then name (K26). Features with a
    single-class target, or in ``all_features`` but absent from the table, get IV 0."""
    iv = bin_table.groupBy("feature").agg(F.coalesce(F.sum(F.when(F.col("valid"), F.col("iv"))), F.lit(0.0)).alias("iv"))
    missing = [f for f in all_features]
    if missing:
        spark = bin_table.sparkSession
        zeros = spark.createDataFrame([(f, 0.0) for f in missing], "feature string, iv double")
        iv = zeros.join(iv, "feature", "left_anti").unionByName(iv)
    return iv.orderBy(F.col("iv").desc(), F.col("feature"))


def bin_summary(bin_table: DataFrame, feature: str) -> DataFrame:
    """WOE9: one feature's bins (empty result when unknown or unmapped)."""
    return bin_table.where((F.col("feature") == feature) & F.col("valid"))


def total_iv(bin_table: DataFrame, feature: str) -> DataFrame:
    """WOE10: total IV of one feature."""
    return bin_table.where(F.col("feature") == feature).agg(F.sum("iv").alias("total_iv"))


# ---- transform ------------------------------------------------------------------------------

def _value_tree(x: Column, cuts: Sequence[float], values: Sequence[float | None]) -> Column:
    """Value of the right-closed bin holding x, as balanced comparisons (code-generated)."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            v = values[lo]
            return F.lit(None).cast("double") if v is None else F.lit(float(v))
        mid = (lo + hi) // 2
        return F.when(x <= F.lit(float(cuts[mid])), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(cuts))


def numeric_mappings(bin_table: DataFrame, value_col: str = "woe") -> dict[str, tuple[list[float], list[float]]]:
    """Cuts and bin values of the numeric features (bounded by features x bins)."""
    found: dict[str, list] = {}
    for r in bin_table.where("valid and kind = 'num'").select("feature", "bin_id", "hi", F.col(value_col).alias("v")).collect():
        found.setdefault(r["feature"], []).append((r["bin_id"], r["hi"], r["v"]))
    return {f: ([hi for _, hi, _ in sorted(x)[:-1]], [v for *_, v in sorted(x)]) for f, x in found.items()}


def _category_values(maps: DataFrame, texts: Sequence[str], value_col: str) -> tuple[dict[str, dict[str, float]], DataFrame, dict[str, int]]:
    """The values of the frequent categories of each feature (at least 1 / FREQUENT of its rows, so at most
    FREQUENT), the table of all others, and how many others each feature has."""
    cats = maps.where((F.col("kind") == "cat") & F.col("feature").isin(list(texts)))
    rows = {r["feature"]: r["rows"] for r in cats.groupBy("feature").agg(F.sum("total").alias("rows")).collect()}  # one for each feature
    of = F.element_at(F.create_map(*[F.lit(x) for item in rows.items() for x in item]), F.col("feature")) if rows else F.lit(0)
    cats = cats.select("feature", "category", F.col(value_col).cast("double").alias("value"), "total", (F.col("total") * FREQUENT >= of).alias("often"))
    often: dict[str, dict[str, float]] = {}
    for r in cats.where("often and value is not null").orderBy(F.col("total").desc(), "category").collect():
        often.setdefault(r["feature"], {})[r["category"]] = r["value"]
    others = cats.where("not often").select("feature", "category", "value")
    return often, others, {r["feature"]: r["count"] for r in others.groupBy("feature").count().collect()}


def _lookup(category: Column, values: Mapping[str, float]) -> Column:
    """Value of a category by a literal table, NULL if it holds none."""
    if not values:
        return F.lit(None).cast("double")
    keys = F.from_json(F.lit(json.dumps([*values])), "array<string>")
    return F.get(double_array([*values.values()]), F.array_position(keys, category).cast("int") - 1)


def transform_woe(
    df: DataFrame,
    bin_table: DataFrame,
    keep: Sequence[str] = (),
    value_col: str = "woe",
    unseen: float | None = 0.0,
    features: Sequence[str] | None = None,
    numeric_unseen: float | None = None,
) -> DataFrame:
    """WOE7: replace each mapped feature by its bin's value (WoE, or points for SCL6).

    Unseen categories and NULLs -> ``unseen`` (0.0; K11 legacy: None). Features without a
    mapping are omitted. Numeric features and the frequent categories of text features are pure expressions.
    Only features that have other categories need more: these categories are broadcast if there are at most
    ``BROADCAST_CATEGORIES`` of them in all; beyond that, the rows with a category that is not frequent go through one
    join by (feature, category) for all features together and one grouping that brings a row's values
    back together, however many text features there are; all other rows stay where they are. A stream is joined feature by feature."""
    if numeric_unseen is None:
        numeric_unseen = unseen
    maps = materialize(bin_table.where("valid").select("feature", "kind", "bin_id", "hi", "category", "total", value_col), "woe-mapping")
    numeric = numeric_mappings(maps.withColumn("valid", F.lit(True)), value_col)
    categorical = [r[0] for r in maps.where("kind = 'cat'").select("feature").distinct().collect()]
    wanted = [f for f in (features or [*numeric, *categorical]) if f in df.columns and (f in numeric or f in categorical)]
    texts = [f for f in wanted if f not in numeric]
    often, others, more = _category_values(maps, texts, value_col) if texts else ({}, None, {})
    cols = []
    for f in wanted:
        if f in numeric:
            cuts, values = numeric[f]
            x = F.col(f).cast("double")
            val = F.when(x.isNull() | F.isnan(x), F.lit(numeric_unseen).cast("double")).otherwise(_value_tree(x, cuts, values))
            cols.append(val.alias(f))
        else:
            cols.append(_lookup(category_text(f), often.get(f, {})).alias(f))
    joined = [f for f in texts if more.get(f)]
    out = df.select(*keep, *cols, *[category_text(f).alias(f"__cat_{f}") for f in joined])
    if joined and (df.isStreaming or sum(more.values()) <= BROADCAST_CATEGORIES):
        for f in joined:
            one = others.where(F.col("feature") == f).select(F.col("category").alias(f"__cat_{f}"), F.col("value").alias(f"__val_{f}"))
            one = F.broadcast(one) if sum(more.values()) <= BROADCAST_CATEGORIES else one
            out = out.join(one, f"__cat_{f}", "left").withColumn(f, F.coalesce(f, f"__val_{f}"))
    elif joined:
        out = _join_others(out, joined, others)
    final = [F.coalesce(F.col(f), F.lit(unseen)).alias(f) if f in texts and unseen is not None else F.col(f) for f in wanted]
    return out.select(*keep, *final)


def _join_others(rows: DataFrame, texts: Sequence[str], others: DataFrame) -> DataFrame:
    """``rows`` whose NULL text features are filled from ``others(feature, category, value)`` by one join for all features."""
    open_ = F.lit(False)
    for f in texts:
        open_ = open_ | F.col(f).isNull()
    asked = F.filter(F.array(*[F.struct(F.lit(f).alias("feature"), F.when(F.col(f).isNull(), F.col(f"__cat_{f}")).alias("category")) for f in texts]),
                     lambda x: x["category"].isNotNull())
    row = F.struct(*[F.col(c) for c in rows.columns]).alias("__row")
    numbered = rows.where(open_).select(F.monotonically_increasing_id().alias("__n"), row, asked.alias("asked"))
    each = numbered.select("__n", "__row", F.explode("asked").alias("a")).select(
        "__n", "__row", F.col("a.feature").alias("feature"), F.col("a.category").alias("category"))
    met = each.join(others, ["feature", "category"], "left").groupBy("__n").agg(
        F.first("__row").alias("__row"), *[F.max(F.when(F.col("feature") == f, F.col("value"))).alias(f"__val_{f}") for f in texts])
    filled = met.select(*[F.coalesce(F.col("__row")[c], F.col(f"__val_{c}")).alias(c) if c in texts else F.col("__row")[c].alias(c) for c in rows.columns])
    return rows.where(~open_).unionByName(filled)


# ---- exploratory utilities (BIN4, WOE6) ------------------------------------------------------

def equal_width_edges(df: DataFrame, feature: str, bins: int = 5) -> list[float]:
    """BIN4 edges as ``pd.cut(x, bins)``: ``bins`` equal widths over [min, max], lowest edge
    lowered by 0.1 % of the range (one aggregation; two numbers collected)."""
    r = df.agg(F.min(F.col(feature).cast("double")).alias("a"), F.max(F.col(feature).cast("double")).alias("b")).first()
    lo, hi = r["a"], r["b"]
    if lo is None:
        raise ValueError(f"{feature} has no values")
    if lo == hi:
        lo, hi = lo - 0.001 * abs(lo) if lo != 0 else lo - 0.001, hi + 0.001 * abs(hi) if hi != 0 else hi + 0.001
        return linspace(lo, hi, bins)
    edges = linspace(lo, hi, bins)
    edges[0] -= (hi - lo) * 0.001
    return edges


def utility_woe_table(
    df: DataFrame,
    feature: str,
    target: str,
    edges: Sequence[float],
    eps: float = 1e-4,
    round_woe: bool = True,
    include_lowest: bool = True,
) -> DataFrame:
    """WOE6 exploratory table on explicit edges e0 < ... < en (right-closed bins, the first one
    closed on the left; values outside [e0, en] fall out). Only observed bins are returned.
    With ``round_woe`` (equal-width variant) WOE is rounded to 4 dp before IV, then IV too."""
    edges = sorted(set(float(e) for e in edges))
    x = F.col(feature).cast("double")
    inside = (x >= F.lit(edges[0]) if include_lowest else x > F.lit(edges[0])) & (x <= F.lit(edges[-1]))
    b = F.when(inside, right_closed_bin(x, edges[1:-1]))
    counts = df.select(b.alias("bin"), F.col(target).cast("long").alias("_y")).where(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.count(F.lit(1)).alias("total_count"), F.sum("_y").alias("event_count"))
    every_bin = Window.partitionBy()  # the observed bins of one feature: a handful of rows
    j = counts.select("*", F.sum("event_count").over(every_bin).alias("_E"),
                      F.sum(F.col("total_count") - F.col("event_count")).over(every_bin).alias("_N"))
    ne = F.col("total_count") - F.col("event_count")
    er = (F.col("event_count") + F.lit(eps)) / F.col("_E")
    nr = (ne + F.lit(eps)) / F.col("_N")
    woe = F.ln(nr / er)
    if round_woe:
        woe = round_half_even(woe, 4)
    lo = F.element_at(F.lit(edges[:-1]), F.col("bin") + 1)
    hi = F.element_at(F.lit(edges[1:]), F.col("bin") + 1)
    out = j.select("bin", lo.alias("lo"), hi.alias("hi"), "total_count", "event_count", ne.alias("non_event_count"),
                   er.alias("event_rate"), nr.alias("non_event_rate"), woe.alias("WOE"))
    iv = (F.col("non_event_rate") - F.col("event_rate")) * F.col("WOE")
    return out.withColumn("IV", round_half_even(iv, 4) if round_woe else iv)
