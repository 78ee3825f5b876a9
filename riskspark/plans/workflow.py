"""End-to-end workflow (WF1) and scoring with saved artefacts (WF3).

Stages 3-6 (read, clean, engineer, split) are written as Parquet in the shared checkpoint folder
because every later stage reuses them; the raw data are read once. Driver round trips carry only bounded results:
imputation values (one per column), tree cuts (<= max_bins - 1 per feature), the bin table
(bins and categories), the selected feature list, coefficients and isotonic boundaries.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.config import ScorecardConfig
from riskspark.operators import calibrate as CA
from riskspark.operators import clean as CL
from riskspark.operators import engineer as EN
from riskspark.operators import metrics as ME
from riskspark.operators import model as MO
from riskspark.operators import policy as PO
from riskspark.operators import scorecard as SC
from riskspark.operators import select as SE
from riskspark.operators import split as SP
from riskspark.operators import tree as TR
from riskspark.operators import woe as WO
from riskspark.operators.isotonic import IsotonicFit
from riskspark.session import materialize, temporary_tables
from riskspark.sources import io


def prepare(spark: SparkSession, cfg: ScorecardConfig, raw: DataFrame) -> tuple[DataFrame, dict]:
    """CLN5 -> FE8 -> SPL1. The shaped rows are written once, so that the raw data are read once; the
    split counts and ranks them, and its result is written too."""
    cleaned = CL.clean_target_and_leakage(raw, cfg.target_col, cfg.loan_status_mapping, cfg.leakage_cols,
                                          cfg.target_binary_col, keep=(cfg.key_col,))
    shaped = cleaned.transform(EN.engineer_dates).transform(EN.engineer_emp_length).transform(EN.engineer_term)
    split = SP.stratified_split(materialize(shaped, "shaped"), cfg.target_binary_col, cfg.key_col, cfg.test_size, cfg.val_size, cfg.random_state)
    split = materialize(split, "prepared")
    fit_src = split if cfg.impute_fit_on == "all" else split.where(F.col("split") == "train")
    values = EN.imputation_values(fit_src, exclude=(cfg.key_col, cfg.target_binary_col, "split"), median_method=cfg.median_method)
    return EN.impute(split, values), values


def fit(spark: SparkSession, cfg: ScorecardConfig, prepared: DataFrame) -> dict:
    """Bins, WoE, selection, logistic fit and isotonic calibration; returns the artefacts."""
    key, y = cfg.key_col, cfg.target_binary_col
    feats = [c for c in prepared.columns if c not in (key, y, "split")]
    kinds = WO.feature_kinds(prepared, feats)
    numeric = [f for f, k in kinds.items() if k == "num"]
    categorical = [f for f, k in kinds.items() if k == "cat"]
    unsupported = [f for f, k in kinds.items() if k == "unsupported"]
    train = prepared.where(F.col("split") == "train")
    cuts = TR.tree_cuts(train, numeric, y, cfg.max_bins, cfg.min_samples_leaf)
    bins = materialize(WO.fit_woe(train, y, cuts, categorical), "bins")
    iv = materialize(WO.iv_summary(bins, unsupported), "iv")
    # only features that pass the IV filter are encoded for the correlation and the fit
    passed = [r["feature"] for r in SE.iv_selection(iv, cfg.iv_min, cfg.iv_max).collect()]
    enc_train = materialize(WO.transform_woe(train, bins, keep=[key, y], features=passed), "encoded-train")
    chosen = SE.select_features(enc_train, iv, cfg.iv_min, cfg.iv_max, cfg.corr_threshold).orderBy("rank").collect()
    selected = [r["feature"] for r in chosen]
    model = MO.fit_logistic(enc_train, selected, y, cfg.c_penalty, cfg.max_iter, cfg.class_weight)
    intercept, coefs = MO.model_parameters(model, selected)
    # the selected features of the other parts, once
    rest = materialize(WO.transform_woe(prepared.where(F.col("split") != "train"), bins, keep=[key, y, "split"], features=selected),
                       "encoded-rest")
    val = rest.where(F.col("split") == "val").withColumn("raw_good", MO.raw_good_probability(intercept, coefs))
    iso = CA.fit_isotonic(val, "raw_good", y)
    return {"cuts": cuts, "bins": bins, "iv": iv, "selected": selected, "model": model, "intercept": intercept,
            "coefficients": coefs, "isotonic": iso, "encoded": rest}


def score(df_encoded: DataFrame, cfg: ScorecardConfig, intercept: float, coefs: dict, iso: IsotonicFit,
          keep: list[str]) -> DataFrame:
    """Row-local scoring of WoE-encoded rows: logit, score, raw and calibrated P(good), PD."""
    scaling = SC.Scaling(cfg.pdo, cfg.base_score, cfg.base_odds)
    logit = SC.logit_expr(intercept, coefs)
    out = df_encoded.select(*keep, logit.alias("logit"), SC.score_expr(logit, scaling).alias("score"),
                            MO.raw_good_probability(intercept, coefs).alias("raw_good"))
    out = CA.calibrated_good(out, iso, "raw_good", "p_good")
    return out.withColumn("pd", 1.0 - F.col("p_good"))


def run(spark: SparkSession, cfg: ScorecardConfig, raw: DataFrame) -> dict[str, DataFrame]:
    """WF1: the whole workflow; a dict of result tables, written in the shared checkpoint folder. All
    other tables written on the way are deleted at the end, also after a failure."""
    key, y = cfg.key_col, cfg.target_binary_col
    with temporary_tables(spark) as keep:
        prepared, impute_values = prepare(spark, cfg, raw)
        art = fit(spark, cfg, prepared)
        for table in (art["bins"], art["iv"], art["encoded"], art["isotonic"].boundaries):
            keep(table)
        test_enc = art["encoded"].where(F.col("split") == "test")
        scored = score(test_enc, cfg, art["intercept"], art["coefficients"], art["isotonic"], [key, y]).withColumnRenamed(y, "target")
        scored = keep(materialize(scored, "scored-test"))
        scaling = SC.Scaling(cfg.pdo, cfg.base_score, cfg.base_odds)
        sweep = keep(materialize(PO.compare_lgd_scenarios(
            scored, cfg.ead, cfg.interest_margin, PO.workflow_scenarios(cfg.lgd_baseline, cfg.lgd_stressed),
            cfg.cutoff_min, cfg.cutoff_max, cfg.cutoff_step), "sweep"))
        results = {
            "discrimination": ME.discrimination(scored, "target", "raw_good"),
            "calibration": ME.calibration_metrics(scored, "target", "p_good"),
            "master_scale": SC.master_scale(scored, "score", "pd", cfg.master_scale_min_score, cfg.master_scale_max_score,
                                            cfg.master_scale_bin_width),
            "decile_table": SC.decile_table(scored, "score", "target"),
            "points_table": SC.points_table(art["bins"], art["intercept"], art["coefficients"], scaling),
            "scenario_summary": PO.scenario_summary(sweep),
        }
        results = {name: keep(materialize(df, name.replace("_", "-"))) for name, df in results.items()}
    return results | {
        "bins": art["bins"],
        "iv": art["iv"],
        "selected": spark.createDataFrame([(i, f) for i, f in enumerate(art["selected"])], "rank int, feature string"),
        "coefficients": MO.coefficients_table(art["model"], art["selected"]),
        "scored": scored,
        "cutoff_simulation": sweep,
        "_artifacts": art | {"impute_values": impute_values},
    }


def summary(results: dict[str, DataFrame]) -> DataFrame:
    """One row: discrimination and calibration metrics of the hold-out test part."""
    d = results["discrimination"].first()
    c = results["calibration"].first()
    spark = results["scored"].sparkSession
    n_feat = len(results["_artifacts"]["selected"])
    return spark.createDataFrame(
        [(float(d["auc"]), float(d["gini"]), float(d["ks_stat"]), float(c["brier_score"]), n_feat)],
        "auc double, gini double, ks_stat double, brier_score double, n_features int")


def save_artifacts(spark: SparkSession, results: dict, out_dir: str, cfg: ScorecardConfig) -> str:
    """SNK1 + SNK2: small tables as CSV; bin table and isotonic boundaries as Parquet; model with the
    ML writer; coefficients, settings and imputation values as JSON."""
    art = results["_artifacts"]
    for name, order in (("master_scale", ["band"]), ("decile_table", ["decile"]), ("cutoff_simulation", ["scenario_order", "Cutoff"]),
                        ("scenario_summary", ["scenario_order"])):  # <= a few hundred rows
        io.write_csv(results[name], f"{out_dir}/{name}", [c for c in order if c in results[name].columns], single_file=True)
    # one row per bin or category of the model features: large with uncapped categoricals (K25)
    points = results["points_table"]
    io.write_csv(points, f"{out_dir}/points_table", ["row_kind", "Feature", "bin_id", "category"])
    art["model"].write().overwrite().save(f"{out_dir}/logistic_model")
    return save_scorecard(spark, art | {"config": {k: v for k, v in asdict(cfg).items() if isinstance(v, (int, float, str, type(None)))}}, out_dir)


def save_scorecard(spark: SparkSession, art: dict, out_dir: str) -> str:
    """What scoring needs (WF3): bin table, isotonic boundaries, and the numbers as JSON."""
    art["bins"].write.mode("overwrite").parquet(f"{out_dir}/bins")
    art["isotonic"].write(f"{out_dir}/isotonic")
    io.save_json(spark, {k: art[k] for k in ("intercept", "coefficients", "selected", "impute_values", "config") if k in art}, f"{out_dir}/scorecard.json")
    return out_dir


def load_model(path: str) -> LogisticRegressionModel:
    """SNK2: a saved logistic model."""
    return LogisticRegressionModel.load(path)


def load_artifacts(spark: SparkSession, out_dir: str, model: bool = True) -> dict:
    """All saved artefacts; without ``model`` only what scoring needs."""
    meta = io.load_json(spark, f"{out_dir}/scorecard.json")
    art = {"bins": spark.read.parquet(f"{out_dir}/bins"), "isotonic": IsotonicFit.load(spark, f"{out_dir}/isotonic"), **meta}
    return art | {"model": load_model(f"{out_dir}/logistic_model")} if model else art


def score_new_data(spark: SparkSession, cfg: ScorecardConfig, raw: DataFrame, art: dict) -> DataFrame:
    """WF3: clean/engineer new rows with the saved imputation values, encode with the saved bin
    table, score and calibrate. Row-local but for categories that are neither frequent nor few (see
    ``transform_woe``); also valid on a streaming DataFrame."""
    key = cfg.key_col
    df = raw
    if cfg.target_col in df.columns:
        df = df.drop(cfg.target_col)
    df = CL.drop_leakage_features(df, cfg.leakage_cols, keep=(key,))
    df = df.transform(EN.engineer_dates).transform(EN.engineer_emp_length).transform(EN.engineer_term)
    df = EN.impute(df, art["impute_values"])
    enc = WO.transform_woe(df, art["bins"], keep=[key], features=art["selected"])
    return score(enc, cfg, art["intercept"], art["coefficients"], art["isotonic"], [key])
