"""Registered queries for cleaning, engineering, splitting and scalar helpers
(CLN1-CLN5, FE1-FE8, SPL1-SPL2, MTH1-MTH3, STR1-STR2) over the ``loans`` fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.config import LEAKAGE_COLUMNS, LOAN_STATUS_MAPPING
from riskspark.functions import exprs as X
from riskspark.operators import clean as C
from riskspark.operators import engineer as E
from riskspark.operators import split as S
from riskspark.plans.catalog import register, rounded, sql_round
from riskspark.session import temporary_tables
from riskspark.sources import fixtures as fx

W = fx.duckdb_with

_MAP_CASE = "CASE loan_status " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LOAN_STATUS_MAPPING.items()) + " END"
_MAPPED_IN = ", ".join(f"'{k}'" for k in LOAN_STATUS_MAPPING)
FEATURES = ["loan_amnt", "installment", "annual_inc", "purpose", "grade", "title", "issue_d",
            "earliest_cr_line", "emp_length", "term"]

# CTE: cleaned loans (CLN5), then engineered (FE1-FE5) and imputed (FE6-FE7)
CLEAN_CTE = (f"c AS (SELECT id, {', '.join(FEATURES)}, CAST({_MAP_CASE} AS INTEGER) AS loan_status_binary "
             f"FROM loans WHERE loan_status IN ({_MAPPED_IN}))")
SHAPED_CTE = """f AS (SELECT id, loan_amnt, installment, annual_inc, purpose, grade, title,
   coalesce(try_cast(regexp_extract(coalesce(emp_length, '< 1 year'), '([0-9]+)', 1) AS INTEGER), 0) AS emp_length,
   loan_status_binary,
   CAST(trunc(date_diff('day', try_strptime(earliest_cr_line, '%b-%Y')::DATE, try_strptime(issue_d, '%b-%Y')::DATE) / 30.4375) AS INTEGER) AS credit_hist_months,
   try_cast(regexp_extract(term, '([0-9]+)', 1) AS DOUBLE) AS term_int
 FROM c WHERE try_strptime(issue_d, '%b-%Y') IS NOT NULL AND try_strptime(earliest_cr_line, '%b-%Y') IS NOT NULL)"""


def _mode_sql(col: str, src: str) -> str:
    return f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1)"


ENGINEERED_CTE = f"""e AS (SELECT id,
   coalesce(loan_amnt, (SELECT coalesce(median(loan_amnt), 0) FROM f)) AS loan_amnt,
   coalesce(installment, (SELECT coalesce(median(installment), 0) FROM f)) AS installment,
   coalesce(annual_inc, (SELECT coalesce(median(annual_inc), 0) FROM f)) AS annual_inc,
   coalesce(purpose, {_mode_sql('purpose', 'f')}) AS purpose,
   coalesce(grade, {_mode_sql('grade', 'f')}) AS grade,
   coalesce(title, {_mode_sql('title', 'f')}) AS title,
   emp_length, loan_status_binary, credit_hist_months, term_int FROM f)"""


_ENG_CTES = [CLEAN_CTE, SHAPED_CTE, ENGINEERED_CTE]


def cleaned(spark, sf):
    return C.clean_target_and_leakage(fx.loans(spark, sf), "loan_status", LOAN_STATUS_MAPPING, LEAKAGE_COLUMNS)


def engineered(spark, sf):
    with temporary_tables(spark):  # what is written on the way goes when the table stands
        return fx.persisted(spark, ("engineered", sf), lambda: E.engineer_features(cleaned(spark, sf)))


@register("cln1_map_target", W() + f"""
SELECT id, loan_status, CAST({_MAP_CASE} AS INTEGER) AS loan_status_binary FROM loans WHERE loan_status IN ({_MAPPED_IN})""")
def cln1(spark, sf):
    return C.map_target(fx.loans(spark, sf), "loan_status", LOAN_STATUS_MAPPING).select("id", "loan_status", "loan_status_binary")


@register("cln2_target_distribution", W(CLEAN_CTE) + f"""
SELECT loan_status_binary, CAST(count(*) AS BIGINT) AS n, {sql_round("count(*) / sum(count(*)) OVER ()", 6)} AS share
FROM c GROUP BY loan_status_binary""")
def cln2(spark, sf):
    d = C.target_distribution(C.map_target(fx.loans(spark, sf), "loan_status", LOAN_STATUS_MAPPING))
    return rounded(d, ("share",))


@register("cln3_unmapped_rows", W() + f"""
SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(count(*) FILTER (WHERE loan_status IN ({_MAPPED_IN})) AS BIGINT) AS kept_rows,
  CAST(count(*) FILTER (WHERE loan_status IS NULL OR loan_status NOT IN ({_MAPPED_IN})) AS BIGINT) AS dropped_rows FROM loans""")
def cln3(spark, sf):
    return C.unmapped_report(fx.loans(spark, sf), "loan_status", LOAN_STATUS_MAPPING)


@register("cln4_drop_leakage", W() + f"SELECT id, {', '.join(FEATURES)} FROM loans")
def cln4(spark, sf):
    return C.drop_leakage_features(fx.loans(spark, sf), LEAKAGE_COLUMNS)


@register("cln5_clean_target_and_leakage", W(CLEAN_CTE) + "SELECT * FROM c")
def cln5(spark, sf):
    return cleaned(spark, sf)


@register("fe1_parse_dates", W() + """
SELECT id, try_strptime(issue_d, '%b-%Y')::DATE AS issue_date, try_strptime(earliest_cr_line, '%b-%Y')::DATE AS earliest_cr_date FROM loans""")
def fe1(spark, sf):
    return fx.loans(spark, sf).select("id", X.parse_month_year("issue_d").alias("issue_date"),
                                      X.parse_month_year("earliest_cr_line").alias("earliest_cr_date"))


@register("fe2_drop_missing_dates", W() + """
SELECT id FROM loans WHERE try_strptime(issue_d, '%b-%Y') IS NOT NULL AND try_strptime(earliest_cr_line, '%b-%Y') IS NOT NULL""")
def fe2(spark, sf):
    return E.engineer_dates(fx.loans(spark, sf)).select("id")


@register("fe3_credit_hist_months", W() + """
SELECT id, CAST(trunc(date_diff('day', try_strptime(earliest_cr_line, '%b-%Y')::DATE, try_strptime(issue_d, '%b-%Y')::DATE) / 30.4375) AS INTEGER) AS credit_hist_months
FROM loans WHERE try_strptime(issue_d, '%b-%Y') IS NOT NULL AND try_strptime(earliest_cr_line, '%b-%Y') IS NOT NULL""")
def fe3(spark, sf):
    return E.engineer_dates(fx.loans(spark, sf)).select("id", "credit_hist_months")


@register("fe4_emp_length", W() + """
SELECT id, emp_length AS emp_length_text,
  coalesce(try_cast(regexp_extract(coalesce(emp_length, '< 1 year'), '([0-9]+)', 1) AS INTEGER), 0) AS emp_length FROM loans""")
def fe4(spark, sf):
    return fx.loans(spark, sf).select("id", F.col("emp_length").alias("emp_length_text"), X.emp_length_years("emp_length").alias("emp_length"))


@register("fe5_term", W() + "SELECT id, try_cast(regexp_extract(term, '([0-9]+)', 1) AS DOUBLE) AS term_int FROM loans")
def fe5(spark, sf):
    return E.engineer_term(fx.loans(spark, sf)).select("id", "term_int")


@register("fe6_impute_median", W() + """
SELECT id, coalesce(annual_inc, (SELECT coalesce(median(annual_inc), 0) FROM loans)) AS annual_inc,
  coalesce(loan_amnt, (SELECT coalesce(median(loan_amnt), 0) FROM loans)) AS loan_amnt FROM loans""")
def fe6(spark, sf):
    df = fx.loans(spark, sf).select("id", "annual_inc", "loan_amnt")
    return E.impute(df, E.imputation_values(df, exclude=("id",)))


@register("fe7_impute_mode", W() + f"SELECT id, coalesce(purpose, {_mode_sql('purpose', 'loans')}) AS purpose FROM loans")
def fe7(spark, sf):
    df = fx.loans(spark, sf).select("id", "purpose")
    return E.impute(df, E.imputation_values(df, exclude=("id",)))


@register("fe8_engineer_features", W(CLEAN_CTE, SHAPED_CTE, ENGINEERED_CTE) + "SELECT * FROM e")
def fe8(spark, sf):
    return E.engineer_features(cleaned(spark, sf))


@register("spl1_stratified_split", W(CLEAN_CTE) + """
, r AS (SELECT id, loan_status_binary,
    row_number() OVER (PARTITION BY loan_status_binary ORDER BY md5(CAST(id AS VARCHAR) || '|' || '42'), id) AS rk,
    count(*) OVER (PARTITION BY loan_status_binary) AS n FROM c),
k AS (SELECT *, round_even(n * 0.2e0, 0) AS nt FROM r)
SELECT id, loan_status_binary, CASE WHEN rk <= nt THEN 'test' WHEN rk <= nt + round_even((n - nt) * 0.25e0, 0) THEN 'val' ELSE 'train' END AS split FROM k""")
def spl1(spark, sf):
    return S.stratified_split(cleaned(spark, sf).select("id", "loan_status_binary"))


@register("spl2_split_report", W(CLEAN_CTE) + f"""
, r AS (SELECT id, loan_status_binary,
    row_number() OVER (PARTITION BY loan_status_binary ORDER BY md5(CAST(id AS VARCHAR) || '|' || '42'), id) AS rk,
    count(*) OVER (PARTITION BY loan_status_binary) AS n FROM c),
k AS (SELECT *, round_even(n * 0.2e0, 0) AS nt FROM r),
s AS (SELECT CASE WHEN rk <= nt THEN 'test' WHEN rk <= nt + round_even((n - nt) * 0.25e0, 0) THEN 'val' ELSE 'train' END AS split FROM k)
SELECT split, CAST(count(*) AS BIGINT) AS rows, {sql_round("count(*) / sum(count(*)) OVER ()", 6)} AS share FROM s GROUP BY split""")
def spl2(spark, sf):
    return rounded(S.split_report(S.stratified_split(cleaned(spark, sf).select("id", "loan_status_binary"))), ("share",))


def _trunc_sql(x: str, d: int = 3) -> str:
    return (f"CAST(sign(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18))) * floor(abs(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18))) * {10**d}) "
            f"/ {10**d} AS DOUBLE)")


@register("mth1_truncate", W() + f"""
SELECT id, {_trunc_sql('loan_amnt / 1000e0')} AS amount_k, {_trunc_sql('-installment / 7e0')} AS neg_installment_7,
  {_trunc_sql('annual_inc / 3e0', 2)} AS income_third FROM loans""")
def mth1(spark, sf):
    l = fx.loans(spark, sf)
    return l.select("id", X.truncate_decimals(F.col("loan_amnt") / 1000.0, 3).alias("amount_k"),
                    X.truncate_decimals(-F.col("installment") / 7.0, 3).alias("neg_installment_7"),
                    X.truncate_decimals(F.col("annual_inc") / 3.0, 2).alias("income_third"))


@register("mth2_round_half_even", W() + """
SELECT id, round_even(loan_amnt / 100e0, 0) AS amount_100, round_even(installment * 10e0, 0) / 10e0 AS installment_1dp,
  round_even(logit * 10000e0, 0) / 10000e0 AS logit_4dp, CAST(round_even(600e0 - 50e0/ln(2e0)*ln(50e0) + 50e0/ln(2e0)*logit, 0) AS INTEGER) AS score
FROM loans JOIN scored USING (id)""")
def mth2(spark, sf):
    l = fx.loans(spark, sf)
    s = fx.scored(spark, sf, l)
    j = l.join(s, "id")
    return j.select("id", X.round_half_even(F.col("loan_amnt") / 100.0).alias("amount_100"),
                    X.round_half_even(F.col("installment"), 1).alias("installment_1dp"),
                    X.round_half_even("logit", 4).alias("logit_4dp"), F.col("score"))


@register("mth3_log_exp_clip_abs", W() + """
SELECT id, round(ln(pd), 9) AS ln_pd, round(exp(logit), 9) AS odds, greatest(least(logit, 1e0), -1e0) AS logit_clipped,
  abs(logit - 2e0) AS abs_dev FROM scored""")
def mth3(spark, sf):
    s = fx.scored(spark, sf)
    out = s.select("id", F.ln("pd").alias("ln_pd"), F.exp("logit").alias("odds"), X.clip("logit", -1.0, 1.0).alias("logit_clipped"),
                   F.abs(F.col("logit") - 2.0).alias("abs_dev"))
    return rounded(out, digits={"ln_pd": 9, "odds": 9})


@register("str1_percent_and_interval_text", W() + """
SELECT id, printf('%.2f%%', pd * 100e0) AS pd_text,
  '(' || CAST(CAST(300 + 50 * (ceil((score - 300) / 50e0) - 1) AS INTEGER) AS VARCHAR) || ', ' ||
  CAST(CAST(300 + 50 * ceil((score - 300) / 50e0) AS INTEGER) AS VARCHAR) || ']' AS band_text FROM scored""")
def str1(spark, sf):
    s = fx.scored(spark, sf)
    hi = (F.lit(300) + F.lit(50) * F.ceil((F.col("score") - 300) / 50.0)).cast("int")
    return s.select("id", X.percent_text("pd").alias("pd_text"), X.interval_text(hi - 50, hi).alias("band_text"))


@register("str2_compact_text", W() + """
SELECT id, CASE WHEN abs(v) >= 1e9 THEN printf('%.2fbn', v / 1e9) WHEN abs(v) >= 1e6 THEN printf('%.2fM', v / 1e6)
  ELSE printf('%.1fK', v / 1e3) END AS money_text,
  CASE WHEN n >= 1000 THEN printf('%.2fK', n / 1000) ELSE printf('%.0f', n) END AS defaults_text,
  CASE WHEN k >= 1000 THEN printf('%.0fK', k / 1000) ELSE CAST(k AS VARCHAR) END AS count_text
FROM (SELECT id, loan_amnt * 2500e0 - 1e8 AS v, installment / 10e0 AS n, CAST(id AS BIGINT) AS k FROM loans)""")
def str2(spark, sf):
    l = fx.loans(spark, sf).select("id", (F.col("loan_amnt") * 2500.0 - 1e8).alias("v"),
                                   (F.col("installment") / 10.0).alias("n"), F.col("id").alias("k"))
    return l.select("id", X.compact_money("v").alias("money_text"), X.compact_defaults("n").alias("defaults_text"),
                    X.compact_count("k").alias("count_text"))
