"""Registered tree-binning, selection and model queries (BIN1, BIN5, WOE4 with trees, SEL1-SEL6,
MOD1-MOD4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.functions.exprs import truncate_decimals
from riskspark.operators import model as MO
from riskspark.operators import select as SE
from riskspark.operators import split as SP
from riskspark.operators import tree as TR
from riskspark.operators import woe as WO
from riskspark.plans.catalog import register, rounded
from riskspark.plans.q_prep import _ENG_CTES as ENG, engineered
from riskspark.plans.q_woe import BIN_RATIOS, CATEGORICAL, GIVEN_CUTS, T, woe_encoded_oracle
from riskspark.session import materialize
from riskspark.sources import fixtures as fx

W = fx.duckdb_with
NUMERIC = list(GIVEN_CUTS)


def _tree_oracle_2leaf(features: list[str]) -> str:
    hist = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, loan_status_binary AS y FROM e WHERE {f} IS NOT NULL" for f in features)
    return W(*ENG, f"lg AS ({hist})") + """
, h AS (SELECT feature, value, count(*) AS n, sum(y) AS good FROM lg GROUP BY ALL),
cc AS (SELECT *, sum(n) OVER w AS nl, sum(good) OVER w AS gl, sum(n) OVER (PARTITION BY feature) AS tn,
        sum(good) OVER (PARTITION BY feature) AS tg, lead(value) OVER (PARTITION BY feature ORDER BY value) AS nv
      FROM h WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
k AS (SELECT *, CAST(ceil(0.05 * tn) AS BIGINT) AS m,
        greatest((gl*gl + (nl-gl)*(nl-gl)) / nl + ((tg-gl)*(tg-gl) + ((tn-nl)-(tg-gl))*((tn-nl)-(tg-gl))) / (tn-nl) - (tg*tg + (tn-tg)*(tn-tg)) / tn, 0e0) AS gain FROM cc),
b AS (SELECT feature, arg_max(value, (gain, -value)) AS v, arg_max(nv, (gain, -value)) AS nv FROM k
      WHERE nv IS NOT NULL AND nl >= m AND tn - nl >= m AND tg > 0 AND tg < tn GROUP BY feature)
SELECT feature, 0 AS cut_index, CASE WHEN v / 2e0 + nv / 2e0 = nv THEN v ELSE v / 2e0 + nv / 2e0 END AS cut FROM b"""


def _cuts_frame(spark, cuts: dict):
    rows = [(f, i, float(c)) for f, cs in cuts.items() for i, c in enumerate(cs)]
    return spark.createDataFrame(rows, "feature string, cut_index int, cut double")


@register("bin1_tree_single_split", _tree_oracle_2leaf(NUMERIC))
def bin1_two_leaves(spark, sf):
    return _cuts_frame(spark, TR.tree_cuts(engineered(spark, sf), NUMERIC, T, max_leaves=2, min_samples_leaf=0.05))


def _tree_oracle_rounds(features: list[str], rounds: int = 5, min_frac: float = 0.05, min_rows_sql: str | None = None,
                        per_leaf: bool = False) -> str:
    """DuckDB text of the best-first tree: ``rounds`` unrolled CTE rounds over the value
    histogram. Round r assigns each value to its leaf from the cuts found so far (k_{r-1}),
    scores every legal split, keeps the best per feature and appends its cut (k_r)."""
    hist = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, loan_status_binary AS y FROM e WHERE {f} IS NOT NULL" for f in features)
    ctes = [*ENG, f"lg AS ({hist})",
            "h AS (SELECT feature, value, count(*) AS n, sum(y) AS good FROM lg GROUP BY ALL)",
            (f"hs AS (SELECT feature, CAST(ceil({min_frac!r} * sum(n)) AS BIGINT) AS m FROM h GROUP BY feature)" if min_rows_sql is None
             else f"hs AS (SELECT feature, CAST({min_rows_sql} AS BIGINT) AS m FROM h GROUP BY feature)"),
            "hc AS (SELECT h.*, sum(n) OVER w AS cn, sum(good) OVER w AS cg, lead(value) OVER (PARTITION BY feature ORDER BY value) AS nv "
            "FROM h WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))",
            "k0 AS (SELECT CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS cut WHERE false)"]
    gain = ("greatest((gl*gl + (nl-gl)*(nl-gl)) / nl + ((tg-gl)*(tg-gl) + ((tn-nl)-(tg-gl))*((tn-nl)-(tg-gl))) / (tn-nl)"
            " - (tg*tg + (tn-tg)*(tn-tg)) / tn, 0e0)")
    for r in range(1, rounds + 1):
        p = f"k{r - 1}"
        ctes += [
            f"l{r} AS (SELECT hc.*, (SELECT count(*) FROM {p} k WHERE k.feature = hc.feature AND hc.value > k.cut) AS leaf FROM hc)",
            f"s{r} AS (SELECT *, min(cn - n) OVER q AS on_, min(cg - good) OVER q AS og, sum(n) OVER q AS tn, sum(good) OVER q AS tg "
            f"FROM l{r} WINDOW q AS (PARTITION BY feature, leaf))",
            f"c{r} AS (SELECT s.feature, s.leaf, s.value, s.nv, s.cn - s.on_ AS nl, s.cg - s.og AS gl, s.tn, s.tg FROM s{r} s JOIN hs USING (feature) "
            "WHERE s.nv IS NOT NULL AND s.tg > 0 AND s.tg < s.tn AND s.cn - s.on_ >= hs.m AND s.tn - (s.cn - s.on_) >= hs.m)",
            f"g{r} AS (SELECT feature, leaf, value, nv, {gain} AS gain FROM c{r})",
            (f"b{r} AS (SELECT feature, arg_max(value, (gain, -value)) AS v, arg_max(nv, (gain, -value)) AS nv FROM g{r} "
             f"GROUP BY feature{', leaf' if per_leaf else ''})"),
            f"k{r} AS (SELECT * FROM {p} UNION ALL SELECT feature, CASE WHEN v / 2e0 + nv / 2e0 = nv THEN v ELSE v / 2e0 + nv / 2e0 END FROM b{r})",
        ]
    return W(*ctes) + (f"SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY cut) - 1 AS INTEGER) AS cut_index, cut "
                       f"FROM k{rounds}")


@register("bin1_tree_cuts", _tree_oracle_rounds(NUMERIC))
def bin1(spark, sf):
    """Best-first tree, <= 6 leaves, >= 5 % of rows per leaf (also checked against an
    independent NumPy tree in tests)."""
    return _cuts_frame(spark, TR.tree_cuts(engineered(spark, sf), NUMERIC, T, max_leaves=6, min_samples_leaf=0.05))


def _trunc3(x: str) -> str:
    d = f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18))"
    return f"CAST(sign({d}) * floor(abs({d}) * 1000) / 1000 AS DOUBLE)"


def _depth_tree_woe_oracle() -> str:
    tree = _tree_oracle_rounds(["annual_inc"], rounds=4, per_leaf=True,
                               min_rows_sql="2000")
    head = tree[: tree.rindex("SELECT feature, CAST(row_number()")]
    return head + f"""
, tc AS (SELECT {_trunc3('cut')} AS e FROM k4
         UNION SELECT {_trunc3('min(annual_inc)')} FROM e UNION SELECT {_trunc3('max(annual_inc)')} FROM e),
ed AS (SELECT e, CAST(row_number() OVER (ORDER BY e) - 1 AS INTEGER) AS i FROM tc),
ne AS (SELECT count(*) AS k, min(e) AS e0, max(e) AS e1 FROM ed),
xb AS (SELECT CAST((SELECT count(*) FROM ed, ne WHERE ed.i BETWEEN 1 AND ne.k - 2 AND x.annual_inc > ed.e) AS INTEGER) AS bin,
              loan_status_binary AS y FROM e x, ne WHERE x.annual_inc >= ne.e0 AND x.annual_inc <= ne.e1),
ct AS (SELECT bin, count(*) AS total_count, sum(y) AS event_count FROM xb GROUP BY bin),
ut AS (SELECT ct.*, total_count - event_count AS non_event_count,
         (event_count + 0.0001e0) / sum(event_count) OVER () AS er,
         (total_count - event_count + 0.0001e0) / sum(total_count - event_count) OVER () AS nr FROM ct)
SELECT ut.bin, lo.e AS lo, hi.e AS hi, CAST(total_count AS BIGINT) AS total_count, CAST(event_count AS BIGINT) AS event_count,
  CAST(non_event_count AS BIGINT) AS non_event_count, round(er, 6) AS event_rate, round(nr, 6) AS non_event_rate,
  round(ln(nr / er), 6) AS WOE, round((nr - er) * ln(nr / er), 6) AS IV
FROM ut JOIN ed lo ON lo.i = ut.bin JOIN ed hi ON hi.i = ut.bin + 1"""


@register("bin5_tree_depth_woe", _depth_tree_woe_oracle())
def bin5(spark, sf):
    """Depth <= 4, >= 2,000 rows per leaf, cuts and edges truncated to 3 dp, eps-WoE table."""
    df = engineered(spark, sf)
    cuts = TR.tree_cuts(df, ["annual_inc"], T, max_leaves=None, min_samples_leaf=2000, max_depth=4)["annual_inc"]
    ends = df.agg(truncate_decimals(F.min("annual_inc"), 3).alias("a"), truncate_decimals(F.max("annual_inc"), 3).alias("b")).first()
    tcuts = [r[0] for r in spark.createDataFrame([(c,) for c in cuts] or [(0.0,)], "c double").select(truncate_decimals("c", 3)).collect()] if cuts else []
    edges = sorted({ends["a"], *tcuts, ends["b"]})
    t = WO.utility_woe_table(df, "annual_inc", T, edges, round_woe=False)
    return rounded(t, ("event_rate", "non_event_rate", "WOE", "IV"))


def _tree_bin_table_oracle() -> str:
    """Bin table on the SQL tree cuts (``k5``): numeric bin = number of cuts below the value,
    every interval kept (empty ones too), categorical bins as in WOE1."""
    tree = _tree_oracle_rounds(NUMERIC)
    head = tree[: tree.rindex("SELECT feature, CAST(row_number()")]
    feats = ", ".join(f"('{f}')" for f in NUMERIC)
    num_long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x, loan_status_binary AS y FROM e" for f in NUMERIC)
    cat_long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, coalesce(CAST({f} AS VARCHAR), 'nan') AS category, loan_status_binary AS y FROM e" for f in CATEGORICAL)
    return head + f"""
, nf AS (SELECT * FROM (VALUES {feats}) v(feature)),
bd AS (SELECT feature, cut AS hi, lag(cut) OVER (PARTITION BY feature ORDER BY cut) AS lo FROM k5
       UNION ALL SELECT nf.feature, 'inf'::DOUBLE, (SELECT max(cut) FROM k5 WHERE k5.feature = nf.feature) FROM nf),
gr AS (SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY hi) - 1 AS INTEGER) AS bin_id,
       coalesce(lo, '-inf'::DOUBLE) AS lo, hi FROM bd),
nl AS (SELECT feature, CAST((SELECT count(*) FROM k5 WHERE k5.feature = u.feature AND u.x > k5.cut) AS INTEGER) AS bin_id, y
       FROM ({num_long}) u WHERE x IS NOT NULL AND NOT isnan(x)),
nc AS (SELECT feature, bin_id, count(*) AS total, sum(y) AS good FROM nl GROUP BY ALL),
cc AS (SELECT feature, category, count(*) AS total, sum(y) AS good FROM ({cat_long}) GROUP BY ALL),
fl AS (SELECT gr.feature, 'num' AS kind, gr.bin_id, gr.lo, gr.hi, CAST(NULL AS VARCHAR) AS category,
              coalesce(nc.total, 0) AS total, coalesce(nc.good, 0) AS good FROM gr LEFT JOIN nc USING (feature, bin_id)
       UNION ALL SELECT feature, 'cat', CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), category, total, good FROM cc),
fb AS (SELECT *, total - good AS bad FROM fl),
tt AS (SELECT feature, sum(good) AS G, sum(bad) AS B, count(*) AS k FROM fb GROUP BY feature),
wt AS (SELECT fb.*, G > 0 AND B > 0 AS valid, (good + 0.5) / (G + 0.5 * k) AS dg, (bad + 0.5) / (B + 0.5 * k) AS db FROM fb JOIN tt USING (feature))
SELECT feature, kind, bin_id, lo, hi, category, CAST(total AS BIGINT) AS total, CAST(good AS BIGINT) AS good, CAST(bad AS BIGINT) AS bad,
  round(CASE WHEN valid THEN dg END, 6) AS dist_good, round(CASE WHEN valid THEN db END, 6) AS dist_bad,
  round(CASE WHEN valid THEN ln(dg / db) END, 6) AS woe, round(CASE WHEN valid THEN (dg - db) * ln(dg / db) END, 6) AS iv,
  round(CASE WHEN total > 0 THEN bad / total END, 6) AS bad_rate, valid FROM wt"""


@register("woe4_fit_with_tree_bins", _tree_bin_table_oracle())
def woe4_tree(spark, sf):
    df = engineered(spark, sf)
    cuts = TR.tree_cuts(df, NUMERIC, T, max_leaves=6, min_samples_leaf=0.05)
    return rounded(WO.fit_woe(df, T, cuts, CATEGORICAL), BIN_RATIOS)


# ---- selection on the given-edge WoE encoding ---------------------------------------------------

_SEL_CTES = woe_encoded_oracle(GIVEN_CUTS, CATEGORICAL)
_IV_CTE = ("iv AS (SELECT feature, round(coalesce(sum(CASE WHEN valid THEN (dg - db) * ln(dg / db) END), 0), 6) AS iv FROM "
           "(SELECT feature, valid, dg, db FROM wt) GROUP BY feature)")


def _encoded(spark, sf):
    df = engineered(spark, sf)
    raw = materialize(WO.fit_woe(df, T, GIVEN_CUTS, CATEGORICAL), "bins")
    bt = rounded(raw, BIN_RATIOS)
    iv = rounded(WO.iv_summary(raw), ("iv",))
    enc = WO.transform_woe(df, bt, keep=["id", T], features=[*CATEGORICAL, *NUMERIC])
    return enc, iv


@register("sel1_iv_filter", W(*_SEL_CTES[:-1], _IV_CTE) + "SELECT feature, iv FROM iv WHERE iv >= 0.02 AND iv <= 0.55")
def sel1(spark, sf):
    _, iv = _encoded(spark, sf)
    return SE.filter_by_iv(iv, 0.02, 0.55)


@register("sel2_top5_fallback", W(*_SEL_CTES[:-1], _IV_CTE) + "SELECT feature, iv FROM iv ORDER BY iv DESC, feature LIMIT 5")
def sel2(spark, sf):
    _, iv = _encoded(spark, sf)
    return SE.iv_selection(iv, 5.0, 9.0)  # nothing passes -> top five


def _pairs_sql(feats_sql: str) -> str:
    return f"""
, sf AS ({feats_sql}),
pr AS (SELECT a.feature AS a, b.feature AS b, CAST(a.pos AS INTEGER) AS a_pos, CAST(b.pos AS INTEGER) AS b_pos FROM sf a JOIN sf b ON a.pos < b.pos)"""


_SELECTED = "SELECT feature, iv, row_number() OVER (ORDER BY iv DESC, feature) - 1 AS pos FROM iv WHERE iv >= 0.02 AND iv <= 0.55"
_FEATS = [*CATEGORICAL, *NUMERIC]
# DuckDB cannot take a column name from a row, so every ordered pair is spelled out.
_CORR_SQL = "SELECT a, b, a_pos, b_pos, (SELECT CASE " + " ".join(
    f"WHEN pr.a = '{x}' AND pr.b = '{y}' THEN (SELECT abs(corr({x}, {y})) FROM we)" for x in _FEATS for y in _FEATS if x != y
) + " END) AS r FROM pr"


@register("sel3_correlation_pairs", W(*_SEL_CTES, _IV_CTE) + _pairs_sql(_SELECTED) + f", cr AS ({_CORR_SQL}) SELECT a, b, a_pos, b_pos, round(r, 6) AS r FROM cr")
def sel3(spark, sf):
    enc, iv = _encoded(spark, sf)
    feats = [r["feature"] for r in SE.filter_by_iv(iv).collect()]
    return rounded(SE.correlation_pairs(enc, feats), ("r",))


_DROPS = (W(*_SEL_CTES, _IV_CTE) + _pairs_sql(_SELECTED) + f", cr AS ({_CORR_SQL}), "
          "dr AS (SELECT DISTINCT CASE WHEN ib.iv > ia.iv THEN cr.a ELSE cr.b END AS feature FROM cr "
          "JOIN iv ia ON ia.feature = cr.a JOIN iv ib ON ib.feature = cr.b WHERE cr.r > @THR@ AND NOT isnan(cr.r)) ")


@register("sel4_collinear_drops", _DROPS.replace("@THR@", "0.7") + "SELECT feature FROM dr")
def sel4(spark, sf):
    enc, iv = _encoded(spark, sf)
    feats = [r["feature"] for r in SE.filter_by_iv(iv).collect()]
    return SE.collinear_drops(SE.correlation_pairs(enc, feats), iv, 0.70)


@register("sel5_select_features", _DROPS.replace("@THR@", "0.7") +
          "SELECT CAST(sf.pos AS INTEGER) AS rank, sf.feature, sf.iv FROM sf WHERE sf.feature NOT IN (SELECT feature FROM dr)")
def sel5(spark, sf):
    enc, iv = _encoded(spark, sf)
    return SE.select_features(enc, iv, 0.02, 0.55, 0.70)


@register("sel6_top_iv_bands", W(*_SEL_CTES[:-1], _IV_CTE) + """
SELECT feature, iv, CASE WHEN iv > 0.55 THEN 'suspicious' WHEN iv >= 0.30 THEN 'strong' WHEN iv >= 0.10 THEN 'medium'
  WHEN iv >= 0.02 THEN 'weak' ELSE 'unpredictive' END AS strength FROM iv ORDER BY iv DESC, feature LIMIT 15""")
def sel6(spark, sf):
    _, iv = _encoded(spark, sf)
    return SE.top_iv_bands(iv, 15)


# ---- model ---------------------------------------------------------------------------------------

@register("mod2_balanced_weights", W(*ENG) + """
SELECT loan_status_binary, CAST(count(*) AS BIGINT) AS n, round(sum(count(*)) OVER () / (2 * count(*)), 9) AS weight FROM e GROUP BY loan_status_binary""")
def mod2(spark, sf):
    w = MO.balanced_weights(engineered(spark, sf), T, "weight")
    return rounded(w.groupBy(T).agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight")), digits={"weight": 9})


def _model_inputs(spark, sf):
    enc, iv = _encoded(spark, sf)
    feats = [r["feature"] for r in SE.select_features(enc, iv).orderBy("rank").collect()]
    split = SP.stratified_split(enc, T, "id")
    return split, feats


def _fit_oracle(select: str, steps: int = 6000) -> str:
    """DuckDB text of the fit: ascent on the distinct WoE vectors of the train part, each coordinate's step bounded by
    the curvature that the loss has at most. Features that were not selected are held at 0 by the penalty."""
    flags = ", ".join(f"(CASE WHEN '{f}' IN (SELECT feature FROM m_chosen) THEN we.{f} ELSE 0 END) AS x{i}" for i, f in enumerate(_FEATS))
    xs = [f"x{i}" for i in range(len(_FEATS))]
    size = " + ".join(["1", *(f"abs({x})" for x in xs)])
    z = " + ".join(["b.b", *(f"b.b{i} * c.{x}" for i, x in enumerate(xs))])
    return _DROPS.replace("@THR@", "0.7").replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, m_chosen AS MATERIALIZED (SELECT sf.feature FROM sf WHERE sf.feature NOT IN (SELECT feature FROM dr)),
m_rk AS (SELECT id, {T} AS y, row_number() OVER (PARTITION BY {T} ORDER BY md5(CAST(id AS VARCHAR) || '|' || '42'), id) AS r, count(*) OVER (PARTITION BY {T}) AS n FROM e),
m_tr AS (SELECT id, y FROM (SELECT *, round_even(n * 0.2e0, 0) AS nt FROM m_rk) WHERE r > nt + round_even((n - nt) * 0.25e0, 0)),
m_cn AS (SELECT {", ".join(xs)}, y, count(*) AS n FROM (SELECT {flags}, m_tr.y FROM we JOIN m_tr USING (id)) GROUP BY ALL),
m_ce AS MATERIALIZED (SELECT m_cn.*, m_cn.n * sum(m_cn.n) OVER () / (2e0 * sum(m_cn.n) OVER (PARTITION BY y)) AS w FROM m_cn),
m_cv AS MATERIALIZED (SELECT sum(w * ({size})) / 4e0 AS d, {", ".join(f"sum(w * abs({x}) * ({size})) / 4e0 + 1e0 AS d{i}" for i, x in enumerate(xs))} FROM m_ce),
m_beta AS (SELECT 0 AS t, 0e0 AS b, {", ".join(f"0e0 AS b{i}" for i in range(len(xs)))}
  UNION ALL SELECT s.t + 1, s.b + s.g / cv.d, {", ".join(f"s.b{i} + (s.g{i} - s.b{i}) / cv.d{i}" for i in range(len(xs)))}
  FROM (SELECT b.t, b.b, {", ".join(f"b.b{i}" for i in range(len(xs)))}, sum(c.w * (c.y - 1e0 / (1e0 + exp(-({z}))))) AS g,
          {", ".join(f"sum(c.w * (c.y - 1e0 / (1e0 + exp(-({z})))) * c.{x}) AS g{i}" for i, x in enumerate(xs))}
        FROM m_beta b, m_ce c WHERE b.t < {steps} GROUP BY b.t, b.b, {", ".join(f"b.b{i}" for i in range(len(xs)))}) s, m_cv cv),
m_fin AS (SELECT * FROM m_beta WHERE t = {steps}),
m_co AS (SELECT '(intercept)' AS feature, b AS coefficient FROM m_fin {" ".join(f"UNION ALL SELECT '{f}', b{i} FROM m_fin WHERE '{f}' IN (SELECT feature FROM m_chosen)" for i, f in enumerate(_FEATS))})
{select}"""


@register("mod1_logistic_fit", _fit_oracle("SELECT feature, round(coefficient, 4) AS coefficient FROM m_co"))
def mod1(spark, sf):
    """Intercept and coefficients of the balanced, L2 logistic fit on the train part."""
    split, feats = _model_inputs(spark, sf)
    b0, coefs = MO.fit_newton(split.where(F.col("split") == "train"), feats, T)
    return rounded(spark.createDataFrame([("(intercept)", b0), *coefs.items()], "feature string, coefficient double"), digits={"coefficient": 4})


@register("mod3_coefficients", _fit_oracle("SELECT feature AS \"Feature\", round(coefficient, 4) AS \"Coefficient\", round(exp(coefficient), 4) AS \"Odds_Ratio\" "
                                           "FROM m_co WHERE feature <> '(intercept)'"))
def mod3(spark, sf):
    split, feats = _model_inputs(spark, sf)
    _, coefs = MO.fit_newton(split.where(F.col("split") == "train"), feats, T)
    return rounded(MO.odds_table(spark, coefs), digits={"Coefficient": 4, "Odds_Ratio": 4})


_MOD4_COEFS = {"purpose": 0.9, "annual_inc": 0.8, "loan_amnt": 0.6, "emp_length": 0.3}


@register("mod4_raw_good_probability", W(*_SEL_CTES) + "SELECT id, round(1e0 / (1e0 + exp(-(0.85e0 + "
          + " + ".join(f"{b!r}e0 * {f}" for f, b in _MOD4_COEFS.items()) + "))), 9) AS raw_good FROM we")
def mod4(spark, sf):
    enc, _ = _encoded(spark, sf)
    return rounded(enc.select("id", MO.raw_good_probability(0.85, _MOD4_COEFS).alias("raw_good")), digits={"raw_good": 9})
