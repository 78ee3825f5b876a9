"""Registered queries of the corpus operators: ``opN_<name>``, each over its whole table with
production parameters, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import (chat_preference, decontaminate, html_lineblocks, langid_ftrl, lm_backoff, minhash_tensor,
                            mix_threshold, periodic_runs, quality_lines, sentencepiece_codec, shard_minimax, token_alignment, warc_derive)
from riskspark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def public_model(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(table(spark, sf_dir, "documents"), public_model("piece_bpe_32k.model"))


@register("op2_quality_lines", quality_lines.ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lines.verdicts(table(spark, sf_dir, "documents"))


@register("op10_html_lineblocks")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_lineblocks.article_text(table(spark, sf_dir, "pages"))


@register("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid_ftrl.languages(table(spark, sf_dir, "documents"))


@register("op9_shard_minimax")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_minimax.shard(table(spark, sf_dir, "documents"))


@register("op3_minhash_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_tensor.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


@register("op8_decontaminate", decontaminate.ORACLE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op5_chat_preference", chat_preference.ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_preference.pairs(table(spark, sf_dir, "conversations"))


@register("op6_warc_derive")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_derive.derivatives(table(spark, sf_dir, "pages"))


@register("op7_stupid_backoff", lm_backoff.ORACLE)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_backoff.rounded(table(spark, sf_dir, "documents"))


@register("op11_mix_threshold", mix_threshold.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_threshold.mix(table(spark, sf_dir, "documents"))


@register("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(table(spark, sf_dir, "documents"))


@register("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.digests(table(spark, sf_dir, "documents"), public_model("byte_bpe_50k.json"), public_model("piece_bpe_32k.model"))
