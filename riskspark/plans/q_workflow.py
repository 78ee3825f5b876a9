"""Registered workflow, source/sink and streaming queries (WF1, WF3, SRC1-SRC2, SNK1-SNK3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.config import ScorecardConfig
from riskspark.operators import clean as CL
from riskspark.operators import engineer as EN
from riskspark.operators import woe as WO
from riskspark.operators.isotonic import IsotonicFit
from riskspark.plans import workflow as WF
from riskspark.plans.catalog import ORACLES, register, rounded
from riskspark.plans.q_model import _SEL_CTES, ENG
from riskspark.plans.q_model import _encoded as encoded
from riskspark.plans.q_prep import cleaned, engineered
from riskspark.plans.q_score import _FACTOR, _OFFSET, DECILE_CTE
from riskspark.plans.q_woe import BIN_RATIOS, CATEGORICAL, GIVEN_CUTS, T
from riskspark.sources import fixtures as fx
from riskspark.sources import io
from riskspark.streaming import scoring as ST

W = fx.duckdb_with
CFG = ScorecardConfig()


def _run(spark, sf):
    return WF.run(spark, CFG, fx.loans(spark, sf))


@register("wf1_workflow_summary")
def wf1(spark, sf):
    """Whole workflow on the loans fixture; hold-out AUC, Gini, KS, Brier and feature count."""
    return WF.summary(_run(spark, sf))


@register("wf1_scenario_summary")
def wf1_scen(spark, sf):
    return _run(spark, sf)["scenario_summary"]


# Scoring is checked with literal artefacts, so that it does not depend on a fit: given bins and coefficients, and an
# isotonic curve of a few boundaries.
_COEFS, _INTERCEPT = {"purpose": 0.9, "annual_inc": 0.8, "loan_amnt": 0.6, "emp_length": 0.3}, 0.85
_CURVE = [(0.3, 0.1), (0.55, 0.4), (0.62, 0.4), (0.7, 0.625), (0.84, 0.9)]


def _curve_sql(x: str) -> str:
    parts = [f"WHEN {x} <= {_CURVE[0][0]!r}e0 THEN {_CURVE[0][1]!r}e0"]
    parts += [f"WHEN {x} <= {b!r}e0 THEN {c!r}e0 + ({d!r}e0 - {c!r}e0) * ({x} - {a!r}e0) / ({b!r}e0 - {a!r}e0)"
              for (a, c), (b, d) in zip(_CURVE, _CURVE[1:])]
    return f"CASE {' '.join(parts)} ELSE {_CURVE[-1][1]!r}e0 END"


_WF3_SQL = W(*_SEL_CTES) + f"""
, z AS (SELECT id, {_INTERCEPT!r}e0 + {" + ".join(f"{b!r}e0 * {f}" for f, b in _COEFS.items())} AS logit FROM we),
r AS (SELECT *, 1e0 / (1e0 + exp(-logit)) AS raw_good FROM z), p AS (SELECT *, {_curve_sql("raw_good")} AS p_good FROM r)
SELECT id, round(logit, 9) AS logit, CAST(round_even({_OFFSET} + {_FACTOR} * logit, 0) AS INTEGER) AS score, round(raw_good, 9) AS raw_good,
  round(p_good, 6) AS p_good, round(1e0 - p_good, 6) AS pd FROM p"""
_WF3_DIGITS = {"logit": 9, "raw_good": 9, "p_good": 6, "pd": 6}


def _saved_scorecard(spark, sf) -> dict:
    """The literal artefacts, with the bins and imputation values of the fixture, saved and loaded back."""
    df = engineered(spark, sf)
    shaped = cleaned(spark, sf).transform(EN.engineer_dates).transform(EN.engineer_emp_length).transform(EN.engineer_term)
    art = {
        "bins": rounded(WO.fit_woe(df, T, GIVEN_CUTS, CATEGORICAL), BIN_RATIOS),
        "isotonic": IsotonicFit.of(spark.createDataFrame(_CURVE, "x double, y double")),
        "intercept": _INTERCEPT, "coefficients": _COEFS, "selected": list(_COEFS),
        "impute_values": EN.imputation_values(shaped, exclude=(CFG.key_col, CFG.target_binary_col)),
    }
    return WF.load_artifacts(spark, WF.save_scorecard(spark, art, io.scratch_path(spark, "scorecard")), model=False)


def _new_loans(spark, sf):
    """Applications of the fixture whose status is known."""
    return CL.map_target(fx.loans(spark, sf), CFG.target_col, CFG.loan_status_mapping).drop("loan_status_binary")


@register("wf3_score_with_saved_artifacts", _WF3_SQL)
def wf3(spark, sf):
    """Artefacts saved, loaded back and used to score raw applications."""
    return rounded(WF.score_new_data(spark, CFG, _new_loans(spark, sf), _saved_scorecard(spark, sf)), digits=_WF3_DIGITS)


@register("wf3_stream_scoring", _WF3_SQL)
def wf3_stream(spark, sf):
    """The saved scorecard applied by a Structured Streaming query to applications arriving as files."""
    art, loans = _saved_scorecard(spark, sf), _new_loans(spark, sf)
    src = io.scratch_path(spark, "incoming")
    loans.write.mode("overwrite").parquet(src)
    dst = io.scratch_path(spark, "scored")
    q = ST.start_parquet_scoring(spark, CFG, src, loans.schema, art, dst, io.scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return rounded(spark.read.parquet(dst), digits=_WF3_DIGITS)


@register("src1_csv_roundtrip", W() + "SELECT * FROM loans")
def src1(spark, sf):
    """Loans written as gzip CSV and read back, the types inferred from the texts (SNK1 + SRC1)."""
    path = io.scratch_path(spark, "loans-csv")
    loans = fx.loans(spark, sf)
    (loans.write.option("header", True).option("compression", "gzip").option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return io.load_raw_data(spark, path)


@register("src2_sample_rows", W() + "SELECT * FROM loans ORDER BY md5(CAST(id AS VARCHAR) || '|' || '42'), id LIMIT 1000")
def src2(spark, sf):
    return io.sample_rows(fx.loans(spark, sf), 1000, 42, "id")


@register("snk1_decile_csv", ORACLES["mst3_decile_table"])
def snk1(spark, sf):
    from riskspark.plans.q_score import mst3

    table = mst3(spark, sf)
    path = io.write_csv(table, io.scratch_path(spark, "deciles"))
    return io.read_csv(spark, path, schema=table.schema)


@register("snk3_read_decile_report", W() + DECILE_CTE + """
SELECT decile, CAST(count(*) AS BIGINT) AS volume, round(1 - avg(target), 6) AS actual_bad_rate FROM d GROUP BY decile""")
def snk3(spark, sf):
    from riskspark.plans.q_score import mst4

    t = mst4(spark, sf).select("decile", "volume", F.col("actual_bad_rate").alias("bad_rate"))
    path = io.write_csv(t, io.scratch_path(spark, "decile-report"))
    return io.read_decile_report(spark, path, schema=t.schema)


@register("snk2_model_roundtrip", W(*ENG) + "SELECT id, true AS same FROM e")
def snk2(spark, sf):
    """A fitted logistic model saved and loaded back: its probabilities of every row equal the formula
    with the coefficients in memory."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from riskspark.operators import model as MO

    enc, _ = encoded(spark, sf)
    features = [c for c in enc.columns if c not in ("id", CFG.target_binary_col)]
    model = MO.fit_logistic(enc, features, CFG.target_binary_col)
    path = io.scratch_path(spark, "logistic")
    model.write().overwrite().save(path)
    scored = WF.load_model(path).transform(VectorAssembler(inputCols=features, outputCol="_features").transform(enc))
    formula = MO.raw_good_probability(*MO.model_parameters(model, features))
    return scored.select("id", (F.abs(vector_to_array("probability")[1] - formula) < 1e-9).alias("same"))
