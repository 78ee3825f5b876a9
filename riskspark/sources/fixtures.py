"""Fixture views derived from the driver's tables (no loan data is shipped).

``loans`` is a wide loan-application table built from ``orders`` joined to ``customer``;
``scored`` is a scored portfolio computed from ``loans`` with literal parameters, so that
scaling, risk tables and policy operators can be checked independently of any model fit.
The same SQL text runs in Spark (DataFrames passed as ``spark.sql`` arguments) and in DuckDB
(plain views), which is what the oracle checks rely on.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskspark.session import at_end_delete, checkpoint_dir

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Columns needed from each base table (the projection reaches the Parquet scan).
_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
_CUSTOMER_COLS = ["c_custkey", "c_acctbal", "c_mktsegment"]

_LOANS_BODY = """
SELECT id,
  CASE WHEN id % 50 = 0 THEN 'Issued'
       WHEN y = 1 THEN CASE id % 3 WHEN 0 THEN 'Fully Paid' WHEN 1 THEN 'Current' ELSE 'In Grace Period' END
       ELSE CASE id % 3 WHEN 0 THEN 'Charged Off' WHEN 1 THEN 'Default' ELSE 'Late (31-120 days)' END END AS loan_status,
  o_totalprice AS loan_amnt,
  o_totalprice * 0.5e0 + (id % 7) AS installment,
  CASE WHEN id % 17 = 0 THEN NULL ELSE c_acctbal END AS annual_inc,
  CASE WHEN id % 23 = 0 THEN NULL ELSE c_mktsegment END AS purpose,
  o_orderpriority AS grade,
  CASE WHEN (id % 10 < 8 AND y = 1) OR (id % 10 >= 8 AND y = 0) THEN 'P' ELSE 'Q' END AS title,
  substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(mm * 3 - 2 AS INT), 3) || '-' || CAST(yy AS STRING) AS issue_d,
  CASE WHEN id % 101 = 0 THEN NULL
       ELSE substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST((id % 12) * 3 + 1 AS INT), 3)
            || '-' || CAST(yy - 5 - id % 20 AS STRING) END AS earliest_cr_line,
  CASE WHEN id % 12 = 0 THEN '< 1 year' WHEN id % 12 = 11 THEN NULL WHEN id % 12 = 10 THEN '10+ years'
       WHEN id % 12 = 1 THEN '1 year' ELSE CAST(id % 12 AS STRING) || ' years' END AS emp_length,
  CASE WHEN id % 4 = 0 THEN ' 60 months' ELSE ' 36 months' END AS term,
  CASE WHEN y = 0 THEN o_totalprice * 0.1e0 ELSE 0e0 END AS recoveries
FROM (
  SELECT o_orderkey AS id, o_totalprice, c_acctbal, c_mktsegment, o_orderpriority,
         year(o_orderdate) AS yy, month(o_orderdate) AS mm,
         CASE WHEN ((o_orderkey * 7919 + 104729) % 1000) / 10e0
                   < 70e0 - o_totalprice / 20000e0 + c_acctbal / 400e0
                     + CASE c_mktsegment WHEN 'BUILDING' THEN 15e0 WHEN 'MACHINERY' THEN -10e0 ELSE 0e0 END
              THEN 1 ELSE 0 END AS y
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey) base
"""

_SCORED_BODY = """
SELECT id, target, logit,
       1e0 / (1e0 + exp(-logit)) AS raw_good,
       1e0 - 1e0 / (1e0 + exp(-logit)) AS pd,
       CAST(@ROUND@(600e0 - 50e0/ln(2e0)*ln(50e0) + 50e0/ln(2e0)*logit, 0) AS INT) AS score
FROM (
  SELECT id,
         CASE WHEN loan_status IN ('Fully Paid','Current','In Grace Period') THEN 1 ELSE 0 END AS target,
         1.8e0 + 1.5e0 * coalesce(annual_inc, 4500e0) / 10000e0 - 2e0 * loan_amnt / 500000e0 AS logit
  FROM {loans} WHERE loan_status <> 'Issued') l
"""


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


_PERSISTED: dict[tuple, str] = {}


def persisted(spark: SparkSession, key: tuple, build) -> DataFrame:
    """Derive an input table once per session and write it as Parquet in the shared checkpoint
    folder (the reference keeps its loan table in memory for every step). Later queries read it
    back with column pruning and filter pushdown, plan against a short lineage, and the table
    survives executor loss."""
    k = (spark.sparkContext.applicationId, *key)
    path = _PERSISTED.get(k)
    if path is None:
        path = at_end_delete(f"{checkpoint_dir(spark).rstrip('/')}/fixture-{key[0]}-{uuid.uuid4().hex[:12]}")
        build().write.mode("overwrite").parquet(path)
        _PERSISTED[k] = path
    return spark.read.parquet(path)  # read with the calling session (any session of the context)


def _view(df: DataFrame, kind: str, sf_dir: str) -> str:
    """Session temp view with a name unique to (kind, folder)."""
    name = f"rs_{kind}_{hashlib.sha1(sf_dir.encode()).hexdigest()[:10]}_{uuid.uuid4().hex[:6]}"
    df.createOrReplaceTempView(name)
    return name


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``loans`` view (FIXTURES §2): orders ⋈ customer on the customer key."""
    def build() -> DataFrame:
        o = _view(table(spark, sf_dir, "orders", _ORDERS_COLS), "orders", sf_dir)
        c = _view(table(spark, sf_dir, "customer", _CUSTOMER_COLS), "customer", sf_dir)
        return spark.sql(_LOANS_BODY.replace("{orders}", o).replace("{customer}", c))

    return persisted(spark, ("loans", sf_dir), build)


def scored(spark: SparkSession, sf_dir: str, loans_df: DataFrame | None = None) -> DataFrame:
    """The ``scored`` view (FIXTURES §3): id, target, logit, raw_good, pd, score."""
    def build(src: DataFrame) -> DataFrame:
        name = _view(src, "loans", sf_dir)
        return spark.sql(_SCORED_BODY.replace("@ROUND@", "bround").replace("{loans}", name))

    if loans_df is not None:
        return build(loans_df)
    return persisted(spark, ("scored", sf_dir), lambda: build(loans(spark, sf_dir)))


# ---- DuckDB text of the same views, used as CTEs by the oracle SQL --------------------------

def duckdb_loans_sql() -> str:
    return _LOANS_BODY.replace("{orders}", "orders").replace("{customer}", "customer")


def duckdb_scored_sql() -> str:
    return _SCORED_BODY.replace("{loans}", "loans").replace("@ROUND@", "round_even")


def duckdb_with(*extra: str) -> str:
    """``WITH loans AS (...), scored AS (...)[, extra...]`` prefix for an oracle query."""
    parts = [f"loans AS ({duckdb_loans_sql()})", f"scored AS ({duckdb_scored_sql()})", *extra]
    return "WITH " + ",\n".join(parts) + "\n"
