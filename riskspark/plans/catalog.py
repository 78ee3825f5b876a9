"""Registered queries: one Spark query per operator of the inventory, each with (where SQL
can express it) a DuckDB oracle over the same parquet tables.

Conventions (shared by both sides): ratios rounded to 6 decimals, money to 2, counts BIGINT,
scores and cutoffs INT. Keys are ``<operator id>_<slug>``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def rounded(df: DataFrame, ratios: tuple[str, ...] = (), money: tuple[str, ...] = (), digits: dict | None = None) -> DataFrame:
    """Round ratio columns to 6 and money columns to 2 decimals (as the oracle does)."""
    spec = {c: 6 for c in ratios} | {c: 2 for c in money} | (digits or {})
    return df.select(*[F.round(F.col(c), spec[c]).alias(c) if c in spec else F.col(c) for c in df.columns])


def sql_round(expr: str, d: int) -> str:
    return f"round(CAST({expr} AS DOUBLE), {d})"


def col(c: str) -> Column:
    return F.col(c)
