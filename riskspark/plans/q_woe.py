"""Registered binning / WoE queries (BIN2-BIN4, BIN6, WOE1-WOE10) over the loans fixture."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from riskspark.config import LOAN_STATUS_MAPPING
from riskspark.operators import clean as C
from riskspark.operators import tree as TR
from riskspark.operators import woe as WO
from riskspark.plans.catalog import register, rounded
from riskspark.plans.q_prep import CLEAN_CTE, ENGINEERED_CTE, SHAPED_CTE, engineered
from riskspark.session import materialize
from riskspark.sources import fixtures as fx

W = fx.duckdb_with
T = "loan_status_binary"
BIN_RATIOS = ("dist_good", "dist_bad", "woe", "iv", "bad_rate")

# Given numeric cuts for the engineered fixture (BIN6 + WOE1 without a tree).
GIVEN_CUTS = {
    "loan_amnt": [100000.0, 200000.0, 300000.0],
    "installment": [50000.0, 100000.0, 150000.0],
    "annual_inc": [0.0, 2500.0, 5000.0, 7500.0],
    "emp_length": [2.0, 5.0, 9.0],
    "term_int": [36.0],
    "credit_hist_months": [100.0, 200.0],
}
CATEGORICAL = ["purpose", "grade", "title"]


def _lit(v: float) -> str:
    if math.isinf(v):
        return "'inf'::DOUBLE" if v > 0 else "'-inf'::DOUBLE"
    return f"CAST({v!r} AS DOUBLE)"


def _case_bin(x: str, cuts: list[float]) -> str:
    arms = " ".join(f"WHEN {x} <= {_lit(c)} THEN {i}" for i, c in enumerate(sorted(cuts)))
    return f"CASE WHEN {x} IS NULL OR isnan(CAST({x} AS DOUBLE)) THEN NULL {arms} ELSE {len(cuts)} END"


def sql_bin_table(src: str, target: str, numeric_cuts: dict, categorical: list[str], smoothing: str = "laplace") -> str:
    """DuckDB text of the bin table (same columns and rounding as the Spark side)."""
    longs = []
    grid = []
    for f, cuts in numeric_cuts.items():
        longs.append(f"SELECT '{f}' AS feature, 'num' AS kind, {_case_bin(f, cuts)} AS bin_id, CAST(NULL AS VARCHAR) AS category, "
                     f"{target} AS y FROM {src}")
        e = [-math.inf, *sorted(cuts), math.inf]
        grid += [f"('{f}', {i}, {_lit(e[i])}, {_lit(e[i + 1])})" for i in range(len(e) - 1)]
    for f in categorical:
        longs.append(f"SELECT '{f}' AS feature, 'cat' AS kind, CAST(NULL AS INTEGER) AS bin_id, coalesce(CAST({f} AS VARCHAR), 'nan') AS category, "
                     f"{target} AS y FROM {src}")
    parts = [f"lg AS ({' UNION ALL '.join(longs)})",
             "cn AS (SELECT feature, kind, bin_id, category, count(*) AS total, sum(y) AS good FROM lg "
             "WHERE kind = 'cat' OR bin_id IS NOT NULL GROUP BY ALL)"]
    if grid:
        parts.append(f"gr AS (SELECT * FROM (VALUES {', '.join(grid)}) v(feature, bin_id, lo, hi))")
        full = ("SELECT gr.feature, 'num' AS kind, CAST(gr.bin_id AS INTEGER) AS bin_id, gr.lo, gr.hi, CAST(NULL AS VARCHAR) AS category, "
                "coalesce(cn.total, 0) AS total, coalesce(cn.good, 0) AS good FROM gr LEFT JOIN cn ON gr.feature = cn.feature AND gr.bin_id = cn.bin_id "
                "UNION ALL SELECT feature, kind, bin_id, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), category, total, good FROM cn WHERE kind = 'cat'")
    else:
        full = "SELECT feature, kind, bin_id, CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi, category, total, good FROM cn"
    parts.append(f"fl AS (SELECT *, total - good AS bad FROM ({full}))")
    parts.append("tt AS (SELECT feature, sum(good) AS G, sum(bad) AS B, count(*) AS k FROM fl GROUP BY feature)")
    if smoothing == "laplace":
        dg, db = "(good + 0.5) / (G + 0.5 * k)", "(bad + 0.5) / (B + 0.5 * k)"
    else:
        dg, db = "(good + 0.5) / G", "(bad + 0.5) / B"
    parts.append(f"wt AS (SELECT fl.*, G > 0 AND B > 0 AS valid, {dg} AS dg, {db} AS db FROM fl JOIN tt USING (feature))")
    body = ("SELECT feature, kind, bin_id, lo, hi, category, CAST(total AS BIGINT) AS total, CAST(good AS BIGINT) AS good, CAST(bad AS BIGINT) AS bad, "
            "round(CASE WHEN valid THEN dg END, 6) AS dist_good, round(CASE WHEN valid THEN db END, 6) AS dist_bad, "
            "round(CASE WHEN valid THEN ln(dg / db) END, 6) AS woe, round(CASE WHEN valid THEN (dg - db) * ln(dg / db) END, 6) AS iv, "
            "round(CASE WHEN total > 0 THEN bad / total END, 6) AS bad_rate, valid FROM wt")
    return parts, body


def _bin_table_oracle(src_ctes: list[str], src: str, numeric_cuts: dict, categorical: list[str], smoothing="laplace", select=None) -> str:
    parts, body = sql_bin_table(src, T, numeric_cuts, categorical, smoothing)
    sel = select or "SELECT * FROM bt"
    return W(*src_ctes, *parts, f"bt AS ({body})") + sel


def _cleaned_loans(spark, sf):
    return C.map_target(fx.loans(spark, sf), "loan_status", LOAN_STATUS_MAPPING)


@register("woe1_purpose", _bin_table_oracle([CLEAN_CTE], "c", {}, ["purpose"]))
def woe1_purpose(spark, sf):
    return rounded(WO.fit_woe(_cleaned_loans(spark, sf), T, None, ["purpose"]), BIN_RATIOS)


@register("bin3_categorical_bins", _bin_table_oracle([CLEAN_CTE], "c", {}, ["purpose", "grade"],
                                                      select="SELECT feature, category, total, good, bad FROM bt"))
def bin3(spark, sf):
    return WO.fit_woe(_cleaned_loans(spark, sf), T, None, ["purpose", "grade"]).select("feature", "category", "total", "good", "bad")


@register("bin6_right_closed_bins", W() + f"""
SELECT id, annual_inc, {_case_bin('annual_inc', GIVEN_CUTS['annual_inc'])} AS bin_id FROM loans""")
def bin6(spark, sf):
    from riskspark.functions.exprs import right_closed_bin
    l = fx.loans(spark, sf)
    return l.select("id", "annual_inc", right_closed_bin("annual_inc", GIVEN_CUTS["annual_inc"]).alias("bin_id"))


@register("woe1_numeric_given_edges", _bin_table_oracle([CLEAN_CTE], "c", {"annual_inc": GIVEN_CUTS["annual_inc"]}, []))
def woe1_numeric(spark, sf):
    return rounded(WO.fit_woe(_cleaned_loans(spark, sf), T, {"annual_inc": GIVEN_CUTS["annual_inc"]}), BIN_RATIOS)


_ENG = [CLEAN_CTE, SHAPED_CTE, ENGINEERED_CTE]
_ENG_CTES = _ENG


@register("woe4_fit_all_features", _bin_table_oracle(_ENG, "e", GIVEN_CUTS, CATEGORICAL))
def woe4(spark, sf):
    return rounded(WO.fit_woe(engineered(spark, sf), T, GIVEN_CUTS, CATEGORICAL), BIN_RATIOS)


@register("woe5_legacy_smoothing", _bin_table_oracle([CLEAN_CTE], "c", {}, ["purpose", "title"], smoothing="legacy"))
def woe5(spark, sf):
    return rounded(WO.fit_woe(_cleaned_loans(spark, sf), T, None, ["purpose", "title"], smoothing="legacy"), BIN_RATIOS)


def _equal_width_sql(feature: str, bins: int = 5) -> list[str]:
    edges = " UNION ALL ".join(
        f"SELECT {i} AS i, CASE WHEN {i} = 0 THEN mn - (mx - mn) * 0.001e0 WHEN {i} = {bins} THEN mx ELSE {i} * ((mx - mn) / {bins}e0) + mn END AS e FROM mm"
        for i in range(bins + 1))
    return [f"mm AS (SELECT min({feature}) AS mn, max({feature}) AS mx FROM c)",
            f"ed AS ({edges})",
            f"bn AS (SELECT c.{T} AS y, (SELECT count(*) FROM ed WHERE ed.i BETWEEN 1 AND {bins - 1} AND c.{feature} > ed.e) AS bin FROM c "
            f"WHERE c.{feature} IS NOT NULL)",
            "ct AS (SELECT bin, count(*) AS total_count, sum(y) AS event_count FROM bn GROUP BY bin)",
            "ut AS (SELECT ct.bin, lo.e AS lo, hi.e AS hi, total_count, event_count, total_count - event_count AS non_event_count, "
            "(event_count + 0.0001e0) / sum(event_count) OVER () AS er, (total_count - event_count + 0.0001e0) / sum(total_count - event_count) OVER () AS nr "
            "FROM ct JOIN ed lo ON lo.i = ct.bin JOIN ed hi ON hi.i = ct.bin + 1)",
            "uw AS (SELECT *, round_even(ln(nr / er) * 10000e0, 0) / 10000e0 AS WOE FROM ut)",
            "uv AS (SELECT *, round_even((nr - er) * WOE * 10000e0, 0) / 10000e0 AS IV FROM uw)"]


@register("woe6_equal_width_eps", W(CLEAN_CTE, *_equal_width_sql("loan_amnt")) + """
SELECT CAST(bin AS INTEGER) AS bin, lo, hi, CAST(total_count AS BIGINT) AS total_count, CAST(event_count AS BIGINT) AS event_count,
  CAST(non_event_count AS BIGINT) AS non_event_count, round(er, 6) AS event_rate, round(nr, 6) AS non_event_rate, WOE, IV FROM uv""")
def woe6(spark, sf):
    df = _cleaned_loans(spark, sf)
    edges = WO.equal_width_edges(df, "loan_amnt", 5)
    return rounded(WO.utility_woe_table(df, "loan_amnt", T, edges), ("event_rate", "non_event_rate"))


@register("woe10_total_iv", W(CLEAN_CTE, *_equal_width_sql("loan_amnt")) + "SELECT sum(IV) AS total_iv FROM uv")
def woe10(spark, sf):
    df = _cleaned_loans(spark, sf)
    t = WO.utility_woe_table(df, "loan_amnt", T, WO.equal_width_edges(df, "loan_amnt", 5))
    return rounded(t.agg(F.sum("IV").alias("total_iv")), digits={"total_iv": 6})


_TRANSFORM_CUTS = {k: GIVEN_CUTS[k] for k in ("loan_amnt", "annual_inc")}
_TRANSFORM_FEATURES = ["purpose", "grade", "title", "loan_amnt", "annual_inc"]


@register("woe8_iv_summary", _bin_table_oracle(_ENG, "e", GIVEN_CUTS, CATEGORICAL,
                                               select="SELECT feature, round(coalesce(sum(CASE WHEN valid THEN iv END), 0), 6) AS iv FROM "
                                                      "(SELECT feature, valid, (dg - db) * ln(dg / db) AS iv FROM wt) GROUP BY feature"))
def woe8(spark, sf):
    bt = WO.fit_woe(engineered(spark, sf), T, GIVEN_CUTS, CATEGORICAL)
    return rounded(WO.iv_summary(bt), ("iv",))


@register("woe9_bin_summary", _bin_table_oracle(_ENG, "e", GIVEN_CUTS, CATEGORICAL, select="SELECT * FROM bt WHERE feature = 'title' AND valid"))
def woe9(spark, sf):
    bt = WO.fit_woe(engineered(spark, sf), T, GIVEN_CUTS, CATEGORICAL)
    return rounded(WO.bin_summary(bt, "title"), BIN_RATIOS)


@register("bin2_constant_feature", W(CLEAN_CTE) + """
, k AS (SELECT count(*) AS n, sum(loan_status_binary) AS g FROM c)
SELECT 'const' AS feature, 'num' AS kind, 0 AS bin_id, '-inf'::DOUBLE AS lo, 'inf'::DOUBLE AS hi, CAST(NULL AS VARCHAR) AS category,
  CAST(n AS BIGINT) AS total, CAST(g AS BIGINT) AS good, CAST(n - g AS BIGINT) AS bad, 1e0 AS dist_good, 1e0 AS dist_bad,
  0e0 AS woe, 0e0 AS iv, round((n - g) / n, 6) AS bad_rate, true AS valid FROM k""")
def bin2(spark, sf):
    df = _cleaned_loans(spark, sf).withColumn("const", F.lit(1.0) + F.col("id") * 0)
    return rounded(WO.fit_woe(df, T, TR.tree_cuts(df, ["const"], T, 6, 0.05)), BIN_RATIOS)


@register("woe2_single_class_target", W(CLEAN_CTE) + """
SELECT f AS feature, 0e0 AS iv FROM (VALUES ('purpose'), ('annual_inc')) v(f)""")
def woe2(spark, sf):
    df = _cleaned_loans(spark, sf).where(F.col(T) == 1)
    bt = WO.fit_woe(df, T, {"annual_inc": GIVEN_CUTS["annual_inc"]}, ["purpose"])
    return WO.iv_summary(bt)


@register("woe3_unsupported_feature", _bin_table_oracle([CLEAN_CTE], "c", {}, ["purpose"],
                                                        select="SELECT 'amount_parts' AS feature, 0e0 AS iv UNION ALL "
                                                               "SELECT feature, round(sum((dg - db) * ln(dg / db)), 6) FROM wt GROUP BY feature"))
def woe3(spark, sf):
    df = _cleaned_loans(spark, sf).withColumn("amount_parts", F.array("loan_amnt", "installment"))
    kinds = WO.feature_kinds(df, ["purpose", "amount_parts"])
    cats = [f for f, k in kinds.items() if k == "cat"]
    unsupported = [f for f, k in kinds.items() if k == "unsupported"]
    bt = WO.fit_woe(df, T, None, cats)
    return rounded(WO.iv_summary(bt, unsupported), ("iv",))


def sql_woe_select(numeric_cuts: dict, categorical: list[str], src: str = "e", extra: str = "") -> str:
    """DuckDB text: id + WoE of each feature from the ``bt`` CTE (unseen/NULL -> 0)."""
    cols = []
    for f in categorical:
        cols.append(f"coalesce((SELECT woe FROM bt WHERE feature = '{f}' AND valid AND category = coalesce(CAST({src}.{f} AS VARCHAR), 'nan')), 0e0) AS {f}")
    for f in numeric_cuts:
        cols.append(f"coalesce((SELECT woe FROM bt WHERE feature = '{f}' AND valid AND {src}.{f} > lo AND {src}.{f} <= hi), 0e0) AS {f}")
    return f"SELECT {src}.id{extra}, {', '.join(cols)} FROM {src}"


def woe_encoded_oracle(numeric_cuts: dict, categorical: list[str], extra: str = "") -> list[str]:
    """CTE list (source ``e`` .. ``bt``, then ``we`` = WoE-encoded rows) for selection oracles."""
    parts, body = sql_bin_table("e", T, numeric_cuts, categorical)
    ctes = [*_ENG, *parts, f"bt AS ({body})", f"we AS ({sql_woe_select(numeric_cuts, categorical, extra=extra)})"]
    return ctes


@register("bin4_equal_width_bins", W(CLEAN_CTE, *_equal_width_sql("installment", 8)[:2]) + """
SELECT id, CASE WHEN installment IS NOT NULL THEN
  CAST((SELECT count(*) FROM ed WHERE ed.i BETWEEN 1 AND 7 AND c.installment > ed.e) AS INTEGER) END AS bin FROM c""")
def bin4(spark, sf):
    """BIN4: equal-width bin of every row (8 bins over [min, max], lowest edge lowered by 0.1 %); NULL
    has no bin."""
    from riskspark.functions.exprs import right_closed_bin

    df = _cleaned_loans(spark, sf)
    edges = WO.equal_width_edges(df, "installment", 8)
    return df.select("id", F.when(F.col("installment").isNotNull(), right_closed_bin("installment", edges[1:-1])).alias("bin"))


def transform_oracle_ctes() -> list[str]:
    """CTEs of the woe7 oracle: engineered source ``e``, bin table ``bt`` (and its parts) and the
    encoded rows ``we``; reused by the scorecard oracles."""
    return woe_encoded_oracle(_TRANSFORM_CUTS, CATEGORICAL)


@register("woe7_transform", W(*transform_oracle_ctes()) + "SELECT * FROM we")
def woe7(spark, sf):
    df = engineered(spark, sf)
    bt = WO.fit_woe(df, T, _TRANSFORM_CUTS, CATEGORICAL)
    bt = materialize(rounded(bt, BIN_RATIOS), "bins")
    return WO.transform_woe(df, bt, keep=["id"], features=["purpose", "grade", "title", "loan_amnt", "annual_inc"])
