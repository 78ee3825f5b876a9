"""Registered policy queries (POL1-POL16) over the ``scored`` fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import policy as P
from riskspark.plans.catalog import register, rounded, sql_round
from riskspark.sources import fixtures as fx

W = fx.duckdb_with

STRATEGY_RATIOS = ("Acceptance_Rate", "Portfolio_Bad_Rate", "Return_On_Exposure")
STRATEGY_MONEY = ("Gross_Revenue", "Total_Empirical_Loss", "Total_Expected_Loss", "Net_Profit",
                  "Expected_Net_Profit", "Net_Profit_Per_Loan")
POLICY_RATIOS = ("approval_rate", "bad_rate", "roe", "expected_defaults")
POLICY_MONEY = ("expected_loss", "expected_profit", "net_profit", "gross_revenue", "empirical_loss")

SWEEP_SCENARIOS = {"Baseline (LGD=45%)": 0.45, "Stressed (LGD=70%)": 0.70}


def _sweep_sql(scenarios: dict[str, float], cmin: int, cmax: int, step: int, ead: float = 20000.0, r: float = 0.10) -> str:
    scen = " UNION ALL ".join(
        f"SELECT {i} AS scenario_order, '{n}' AS Scenario, CAST({l!r} AS DOUBLE) AS lgd"
        for i, (n, l) in enumerate(scenarios.items())
    )
    ok = "a.approved > 0"
    return W(
        f"g AS (SELECT CAST(range AS INTEGER) AS cutoff FROM range({cmin}, {cmax + step}, {step}))",
        "n AS (SELECT count(*) AS total FROM scored)",
        "a AS (SELECT g.cutoff, count(s.id) AS approved, coalesce(sum(s.target), 0) AS good, "
        "coalesce(sum(1e0 - s.pd), 0) AS sum_npd, coalesce(sum(s.pd), 0) AS sum_pd "
        "FROM g LEFT JOIN scored s ON s.score >= g.cutoff GROUP BY g.cutoff)",
        f"sc AS ({scen})",
    ) + f"""
SELECT sc.scenario_order, sc.Scenario, sc.lgd, a.cutoff AS Cutoff,
  CAST(a.approved AS BIGINT) AS Approved_Count,
  CAST(n.total - a.approved AS BIGINT) AS Rejected_Count,
  {sql_round(f"CASE WHEN {ok} THEN a.approved / n.total ELSE 0 END", 6)} AS Acceptance_Rate,
  CAST(a.good AS BIGINT) AS Good_Count,
  CAST(a.approved - a.good AS BIGINT) AS Bad_Count,
  {sql_round(f"CASE WHEN {ok} THEN (a.approved - a.good) / a.approved ELSE 0 END", 6)} AS Portfolio_Bad_Rate,
  {sql_round(f"a.good * {ead}e0 * {r}e0", 2)} AS Gross_Revenue,
  {sql_round(f"(a.approved - a.good) * {ead}e0 * sc.lgd", 2)} AS Total_Empirical_Loss,
  {sql_round(f"a.sum_pd * {ead}e0 * sc.lgd", 2)} AS Total_Expected_Loss,
  {sql_round(f"a.good * {ead}e0 * {r}e0 - (a.approved - a.good) * {ead}e0 * sc.lgd", 2)} AS Net_Profit,
  {sql_round(f"a.sum_npd * {ead}e0 * {r}e0 - a.sum_pd * {ead}e0 * sc.lgd", 2)} AS Expected_Net_Profit,
  {sql_round(f"CASE WHEN {ok} THEN (a.good * {ead}e0 * {r}e0 - (a.approved - a.good) * {ead}e0 * sc.lgd) / a.approved ELSE 0 END", 2)} AS Net_Profit_Per_Loan,
  {sql_round(f"CASE WHEN {ok} THEN (a.good * {ead}e0 * {r}e0 - (a.approved - a.good) * {ead}e0 * sc.lgd) / (a.approved * {ead}e0) ELSE 0 END", 6)} AS Return_On_Exposure
FROM a, n, sc
"""


def _sweep(spark, sf, scenarios=SWEEP_SCENARIOS):
    return P.compare_lgd_scenarios(fx.scored(spark, sf), 20000.0, 0.10, scenarios, 380, 650, 5)


@register("pol1_expected_loss", W() + f"""
SELECT id, {sql_round("pd * 20000e0 * 0.45e0", 2)} AS expected_loss FROM scored""")
def pol1(spark, sf):
    s = fx.scored(spark, sf)
    return rounded(s.select("id", P.expected_loss("pd", 20000.0, 0.45).alias("expected_loss")), money=("expected_loss",))


@register("pol2_cutoff_sweep", _sweep_sql({"Baseline (LGD=45%)": 0.45}, 380, 650, 5))
def pol2(spark, sf):
    sim = P.simulate_cutoff_strategy(fx.scored(spark, sf), 20000.0, 0.10, 0.45, 380, 650, 5, "Baseline (LGD=45%)")
    return rounded(sim, STRATEGY_RATIOS, STRATEGY_MONEY)


def _policy_sql(rows: str, clip_lgd: bool = True) -> str:
    lgd = "greatest(least(p.lgd, 1e0), 0e0)" if clip_lgd else "p.lgd"
    ok = "a.approved > 0"
    return W(
        f"p AS ({rows})",
        "n AS (SELECT count(*) AS total FROM scored)",
        "a AS (SELECT p.cutoff, count(s.id) AS approved, coalesce(sum(s.target), 0) AS good, "
        "coalesce(sum(s.pd), 0e0) AS sum_pd FROM (SELECT DISTINCT cutoff FROM p) p "
        "LEFT JOIN scored s ON s.score >= p.cutoff GROUP BY p.cutoff)",
    ) + f"""
, m AS (SELECT p.*, {lgd} AS lgd_c, a.approved, a.good, a.sum_pd, n.total FROM p JOIN a ON p.cutoff = a.cutoff, n)
SELECT @EXTRA@ cutoff,
  CAST(approved AS BIGINT) AS approved_count,
  CAST(total - approved AS BIGINT) AS rejected_count,
  {sql_round("CASE WHEN approved > 0 THEN approved / total ELSE 0 END", 6)} AS approval_rate,
  {sql_round("CASE WHEN approved > 0 THEN sum_pd * ead * lgd_c ELSE 0 END", 2)} AS expected_loss,
  {sql_round("CASE WHEN approved > 0 THEN sum_pd ELSE 0 END", 6)} AS expected_defaults,
  {sql_round("CASE WHEN approved > 0 THEN (approved - sum_pd) * ead * margin - sum_pd * ead * lgd_c ELSE 0 END", 2)} AS expected_profit,
  {sql_round("CASE WHEN approved > 0 THEN good * ead * margin - (approved - good) * ead * lgd_c ELSE 0 END", 2)} AS net_profit,
  {sql_round("CASE WHEN approved > 0 THEN good * ead * margin ELSE 0 END", 2)} AS gross_revenue,
  {sql_round("CASE WHEN approved > 0 THEN (approved - good) * ead * lgd_c ELSE 0 END", 2)} AS empirical_loss,
  {sql_round("CASE WHEN approved > 0 THEN (approved - good) / approved ELSE 0 END", 6)} AS bad_rate,
  {sql_round("CASE WHEN approved > 0 THEN (good * ead * margin - (approved - good) * ead * lgd_c) / (approved * ead) ELSE 0 END", 6)} AS roe
FROM m"""


_ONE = "SELECT CAST(480 AS INTEGER) AS cutoff, 0.5e0 AS lgd, 0.10e0 AS margin, 20000e0 AS ead"


@register("pol3_evaluate_cutoff", _policy_sql(_ONE).replace("@EXTRA@", ""))
def pol3(spark, sf):
    return rounded(P.evaluate_cutoff(fx.scored(spark, sf), 480, 0.5, 0.10, 20000.0), POLICY_RATIOS, POLICY_MONEY)


_PRESETS = " UNION ALL ".join(
    f"SELECT {i} AS policy_order, '{n}' AS policy, CAST({c} AS INTEGER) AS cutoff, {l!r}e0 AS lgd, {m!r}e0 AS margin, 20000e0 AS ead"
    for i, (n, c, l, m) in enumerate(P.PRESET_POLICIES)
)


def _money_text(x: str) -> str:
    return (f"CASE WHEN abs({x}) >= 1e9 THEN printf('%.2fbn', {x} / 1e9) "
            f"WHEN abs({x}) >= 1e6 THEN printf('%.2fM', {x} / 1e6) "
            f"ELSE printf('%.1fK', {x} / 1e3) END")


@register("pol4_policy_presets", "SELECT policy_order, policy, lgd, interest_margin, ead, cutoff, approved_count, rejected_count, "
          "approval_rate, expected_loss, expected_defaults, expected_profit, net_profit, gross_revenue, empirical_loss, bad_rate, roe, "
          "printf('%.2f', approval_rate) AS approval_rate_text, "
          f"{_money_text('expected_loss')} AS expected_loss_text, "
          "CASE WHEN expected_defaults >= 1000 THEN printf('%.2fK', expected_defaults / 1000) "
          "ELSE printf('%.0f', expected_defaults) END AS expected_defaults_text, "
          f"{_money_text('expected_profit')} AS expected_profit_text, "
          "CASE WHEN approved_count >= 1000 THEN printf('%.0fK', approved_count / 1000) "
          "ELSE CAST(approved_count AS VARCHAR) END AS approved_count_text FROM ("
          + _policy_sql(_PRESETS).replace("@EXTRA@", "policy_order, policy, lgd_c AS lgd, margin AS interest_margin, ead,")
          + ")")
def pol4(spark, sf):
    out = P.evaluate_policies(fx.scored(spark, sf))
    # texts are computed on unrounded values; round the numeric columns afterwards
    return rounded(out, POLICY_RATIOS, POLICY_MONEY)


_SWEEP5 = "SELECT CAST(range AS INTEGER) AS cutoff, 0.5e0 AS lgd, 0.10e0 AS margin, 20000e0 AS ead FROM range(350, 655, 5)"


@register("pol5_simulator_sweep", "SELECT cutoff AS Cutoff, approved_count AS Approved_Count, approval_rate AS Approval_Rate, "
          "bad_rate AS Bad_Rate, net_profit AS Net_Profit, expected_profit AS Expected_Profit, expected_loss AS Expected_Loss, "
          "expected_defaults AS Expected_Defaults, gross_revenue AS Gross_Revenue, empirical_loss AS Empirical_Loss, roe AS ROE FROM ("
          + _policy_sql(_SWEEP5).replace("@EXTRA@", "") + ")")
def pol5(spark, sf):
    out = P.simulate_sweep(fx.scored(spark, sf), 0.5, 0.10, 20000.0, 350, 650, 5)
    return rounded(out, ("Approval_Rate", "Bad_Rate", "ROE", "Expected_Defaults"),
                   ("Net_Profit", "Expected_Profit", "Expected_Loss", "Gross_Revenue", "Empirical_Loss"))


# Buckets over the fixture's score range (scores 294-555), with one overlapping pair.
FIXTURE_BUCKETS = ((300, 350), (350, 400), (400, 450), (450, 500), (500, 550), (380, 420), (550, 600))


def _bucket_body(buckets) -> str:
    rows = " UNION ALL ".join(f"SELECT {i} AS bucket_order, {lo} AS low, {hi} AS high" for i, (lo, hi) in enumerate(buckets))
    return W(f"b AS ({rows})") + """, x AS (
  SELECT b.bucket_order, b.low, b.high, count(s.id) AS cnt, sum(s.pd) AS sum_pd
  FROM b LEFT JOIN scored s ON s.score > b.low AND s.score <= b.high GROUP BY ALL)
"""


_BUCKET_BODY = _bucket_body(FIXTURE_BUCKETS)
_BREAKDOWN_SQL = f"""
SELECT bucket_order, '(' || low || ', ' || high || ']' AS score_bucket, CAST(cnt AS BIGINT) AS Bucket_Count,
  {sql_round("CASE WHEN cnt > 0 THEN sum_pd / cnt ELSE 0 END", 6)} AS Bucket_Avg_PD,
  {sql_round("CASE WHEN cnt > 0 THEN sum_pd * 20000e0 * 0.5e0 ELSE 0 END", 2)} AS Bucket_Expected_Loss,
  CAST(low AS DOUBLE) AS _low
FROM x"""


@register("pol6_default_buckets", _bucket_body(P.DEFAULT_BUCKETS) + _BREAKDOWN_SQL)
def pol6_default(spark, sf):
    b = P.score_bucket_breakdown(fx.scored(spark, sf))
    return rounded(P.sort_bucket_breakdown(b), ("Bucket_Avg_PD",), ("Bucket_Expected_Loss",))


@register("pol6_bucket_breakdown", _BUCKET_BODY + _BREAKDOWN_SQL)
def pol6(spark, sf):
    b = P.score_bucket_breakdown(fx.scored(spark, sf), 0.5, 20000.0, FIXTURE_BUCKETS)
    return rounded(P.sort_bucket_breakdown(b), ("Bucket_Avg_PD",), ("Bucket_Expected_Loss",))


@register("pol6_bucket_totals", _BUCKET_BODY + f"""
SELECT CAST(sum(cnt) AS BIGINT) AS Total_Count,
  {sql_round("CASE WHEN sum(cnt) > 0 THEN sum(CASE WHEN cnt > 0 THEN sum_pd ELSE 0 END) / sum(cnt) ELSE 0 END", 6)} AS Total_Avg_PD,
  {sql_round("sum(CASE WHEN cnt > 0 THEN sum_pd * 20000e0 * 0.5e0 ELSE 0 END)", 2)} AS Total_Expected_Loss
FROM x""")
def pol6_totals(spark, sf):
    b = P.score_bucket_breakdown(fx.scored(spark, sf), 0.5, 20000.0, FIXTURE_BUCKETS)
    return rounded(P.bucket_totals(b), ("Total_Avg_PD",), ("Total_Expected_Loss",))


@register("pol7_cumulative_buckets", _BUCKET_BODY + f"""
SELECT bucket_order, '(' || low || ', ' || high || ']' AS score_bucket, CAST(low AS DOUBLE) AS _low,
  CAST(sum(cnt) OVER w AS BIGINT) AS Cum_Count,
  {sql_round("sum(coalesce(sum_pd, 0) * 20000e0 * 0.5e0) OVER w", 2)} AS Cum_Expected_Loss,
  {sql_round("CASE WHEN sum(cnt) OVER w > 0 THEN sum(coalesce(sum_pd, 0)) OVER w / sum(cnt) OVER w ELSE 0 END", 6)} AS Cum_Avg_PD
FROM x WINDOW w AS (ORDER BY low, bucket_order ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def pol7(spark, sf):
    b = P.score_bucket_breakdown(fx.scored(spark, sf), 0.5, 20000.0, FIXTURE_BUCKETS)
    return rounded(P.cumulative_buckets(b), ("Cum_Avg_PD",), ("Cum_Expected_Loss",))


_SWEEP2 = _sweep_sql(SWEEP_SCENARIOS, 380, 650, 5)


@register("pol8_optimal_cutoff", f"""
SELECT Scenario, Cutoff, Net_Profit, Approved_Count, Acceptance_Rate, Portfolio_Bad_Rate FROM (
  SELECT *, row_number() OVER (PARTITION BY Scenario ORDER BY Net_Profit DESC, Cutoff) AS rn FROM ({_SWEEP2})) WHERE rn = 1""")
def pol8(spark, sf):
    sim = _sweep(spark, sf)
    best = P.find_optimal_cutoff(sim)
    return rounded(best.select("Scenario", "Cutoff", "Net_Profit", "Approved_Count", "Acceptance_Rate", "Portfolio_Bad_Rate"),
                   ("Acceptance_Rate", "Portfolio_Bad_Rate"), ("Net_Profit",))


@register("pol9_risk_constrained_cutoff", f"""
SELECT Scenario, Cutoff, Net_Profit, Portfolio_Bad_Rate FROM (
  SELECT *, row_number() OVER (PARTITION BY Scenario ORDER BY Net_Profit DESC, Cutoff) AS rn FROM ({_SWEEP2})
  WHERE Portfolio_Bad_Rate <= 0.25 AND Approved_Count > 0) WHERE rn = 1""")
def pol9(spark, sf):
    best = P.find_risk_constrained_cutoff(_sweep(spark, sf), 0.25)
    return rounded(best.select("Scenario", "Cutoff", "Net_Profit", "Portfolio_Bad_Rate"), ("Portfolio_Bad_Rate",), ("Net_Profit",))


@register("pol10_lgd_scenarios", _SWEEP2)
def pol10(spark, sf):
    return rounded(_sweep(spark, sf), STRATEGY_RATIOS, STRATEGY_MONEY)


SWEEP_COLUMNS = ("Cutoff", "Approved_Count", "Rejected_Count", "Acceptance_Rate", "Good_Count", "Bad_Count", "Portfolio_Bad_Rate",
                 "Gross_Revenue", "Total_Empirical_Loss", "Total_Expected_Loss", "Net_Profit", "Expected_Net_Profit",
                 "Net_Profit_Per_Loan", "Return_On_Exposure")


def _constrained_sql(limit: float, what: str) -> str:
    return (f"(SELECT {what} FROM t t2 WHERE t2.Scenario = t.Scenario AND Portfolio_Bad_Rate <= {limit} AND Approved_Count > 0 "
            "ORDER BY Net_Profit DESC, Cutoff LIMIT 1)")


@register("pol10_scenario_summary", f"""
WITH t AS ({_SWEEP2})
SELECT scenario_order, Scenario, max(lgd) AS lgd,
  first(Cutoff ORDER BY Net_Profit DESC, Cutoff) AS optimal_cutoff,
  first(Net_Profit ORDER BY Net_Profit DESC, Cutoff) AS max_profit,
  first(Acceptance_Rate ORDER BY Net_Profit DESC, Cutoff) AS optimal_acceptance_rate,
  first(Portfolio_Bad_Rate ORDER BY Net_Profit DESC, Cutoff) AS optimal_bad_rate,
  first(Approved_Count ORDER BY Net_Profit DESC, Cutoff) AS optimal_approved_count,
  {", ".join(f"{_constrained_sql(k / 100, c)} AS constrained_{k}pct_{c}" for k in (3, 5) for c in SWEEP_COLUMNS)}
FROM t GROUP BY scenario_order, Scenario""")
def pol10_summary(spark, sf):
    return P.scenario_summary(rounded(_sweep(spark, sf), STRATEGY_RATIOS, STRATEGY_MONEY))


@register("pol11_scenario_labels", f"SELECT DISTINCT scenario_order, Scenario AS label FROM ({_SWEEP2})")
def pol11(spark, sf):
    labels = {P.scenario_label("Baseline", 0.45): 0.45, P.scenario_label("Stressed", 0.70): 0.70}
    return _sweep(spark, sf, labels).select("scenario_order", F.col("Scenario").alias("label")).distinct()


@register("pol12_acceptance_frontier", f"SELECT Cutoff, Acceptance_Rate, Portfolio_Bad_Rate FROM ({_SWEEP2}) WHERE scenario_order = 0")
def pol12(spark, sf):
    return P.acceptance_frontier(rounded(_sweep(spark, sf), STRATEGY_RATIOS, STRATEGY_MONEY))


@register("pol13_profit_frontier", f"""
WITH t AS ({_SWEEP2}), o AS (SELECT Scenario, first(Cutoff ORDER BY Net_Profit DESC, Cutoff) AS opt FROM t GROUP BY Scenario)
SELECT t.Scenario, t.Cutoff, round(t.Net_Profit / 1e6, 6) AS Net_Profit_M, t.Cutoff = o.opt AS is_optimal FROM t JOIN o USING (Scenario)""")
def pol13(spark, sf):
    pf = P.profit_frontier(rounded(_sweep(spark, sf), STRATEGY_RATIOS, STRATEGY_MONEY))
    return rounded(pf, ("Net_Profit_M",))


@register("pol14_dashboard_axes", f"""
WITH t AS ({_SWEEP2}), d AS (SELECT *, Cutoff - lag(Cutoff) OVER (PARTITION BY Scenario ORDER BY Cutoff) AS dd FROM t)
SELECT Scenario, coalesce(median(dd), 5e0) AS cutoff_step, min(Net_Profit) AS min_net_profit, max(Net_Profit) AS max_net_profit,
  max(Portfolio_Bad_Rate) AS max_bad_rate, coalesce(median(dd), 5e0) * 0.75 AS bar_width,
  round(CASE WHEN min(Net_Profit) < 0 THEN min(Net_Profit) * 1.10 ELSE 0e0 END, 2) AS profit_axis_low, round(max(Net_Profit) * 1.10, 2) AS profit_axis_high,
  round(CASE WHEN max(Portfolio_Bad_Rate) > 0 THEN max(Portfolio_Bad_Rate) * 1.15 ELSE 0.20e0 END, 6) AS bad_rate_axis_high FROM d GROUP BY Scenario""")
def pol14(spark, sf):
    axes = P.dashboard_axes(rounded(_sweep(spark, sf), STRATEGY_RATIOS, STRATEGY_MONEY))
    return rounded(axes, ("bad_rate_axis_high",), ("profit_axis_low", "profit_axis_high"))


@register("pol14_dashboard_series", f"SELECT Scenario, Cutoff, Net_Profit AS bar, Portfolio_Bad_Rate AS line FROM ({_SWEEP2})")
def pol14_series(spark, sf):
    return P.dashboard_series(rounded(_sweep(spark, sf), STRATEGY_RATIOS, STRATEGY_MONEY))


# Band targets for re-anchoring (low, high, target mean PD) over the fixture's score range.
FIXTURE_BANDS = ((250, 400), (400, 450), (450, 600))
FIXTURE_BAND_TARGETS = (0.40, 0.25, 0.10)


@register("pol15_rescale_pd", W() + f"""
, b AS (SELECT id, pd, CASE WHEN score > 250 AND score <= 400 THEN 0 WHEN score > 400 AND score <= 450 THEN 1
                        WHEN score > 450 AND score <= 600 THEN 2 END AS band FROM scored),
t AS (SELECT * FROM (VALUES (0, 0.40e0), (1, 0.25e0), (2, 0.10e0)) v(band, tgt)),
m AS (SELECT band, avg(pd) AS mpd FROM b WHERE band IS NOT NULL GROUP BY band)
SELECT b.id, b.band, {sql_round("CASE WHEN m.mpd IS NOT NULL THEN b.pd * (t.tgt / m.mpd) ELSE b.pd END", 9)} AS pd
FROM b LEFT JOIN m USING (band) LEFT JOIN t USING (band)""")
def pol15(spark, sf):
    bands = [(lo, hi, t) for (lo, hi), t in zip(FIXTURE_BANDS, FIXTURE_BAND_TARGETS)]
    out = P.rescale_pd_to_band_means(fx.scored(spark, sf).select("id", "score", "pd"), bands)
    return rounded(out.select("id", "band", "pd"), digits={"pd": 9})


@register("pol15_band_means", W() + f"""
, b AS (SELECT pd, CASE WHEN score > 250 AND score <= 400 THEN 0 WHEN score > 400 AND score <= 450 THEN 1
                        WHEN score > 450 AND score <= 600 THEN 2 END AS band FROM scored),
t AS (SELECT * FROM (VALUES (0, 0.40e0), (1, 0.25e0), (2, 0.10e0)) v(band, tgt)),
m AS (SELECT band, avg(pd) AS mpd, count(*) AS n FROM b WHERE band IS NOT NULL GROUP BY band)
SELECT band, CAST(n AS BIGINT) AS n, {sql_round("t.tgt", 6)} AS mean_pd FROM m JOIN t USING (band)""")
def pol15_means(spark, sf):
    bands = [(lo, hi, t) for (lo, hi), t in zip(FIXTURE_BANDS, FIXTURE_BAND_TARGETS)]
    out = P.rescale_pd_to_band_means(fx.scored(spark, sf).select("id", "score", "pd"), bands)
    agg = out.where(F.col("band").isNotNull()).groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.avg("pd").alias("mean_pd"))
    return rounded(agg, ("mean_pd",))


@register("pol16_portfolio_totals", W() + f"""
SELECT CAST(count(*) AS BIGINT) AS rows, {sql_round("avg(pd)", 6)} AS mean_pd, {sql_round("avg(target)", 6)} AS mean_target FROM scored""")
def pol16(spark, sf):
    return rounded(P.portfolio_totals(fx.scored(spark, sf)), ("mean_pd", "mean_target"))
