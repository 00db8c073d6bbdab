"""The queries of this package, and their SQL."""

from __future__ import annotations

import os
import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rangelake.llm import decontamination, exact_dedup, language_id, language_model, near_duplicates, packing, pii, secret_scan, token_output, url_filter
from rangelake.llm.shared import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_output(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op6_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under the key of RANGELAKE_PII_KEY; without it under one that is drawn for this run and forgotten."""
    return pii.surrogates(table(spark, sf_dir, "documents"), os.environ.get("RANGELAKE_PII_KEY") or secrets.token_hex(32))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    with_sql = {"op1_exact_dedup": exact_dedup, "op2_url_filter": url_filter, "op7_ngram_jaccard_join": near_duplicates, "op10_secret_scan": secret_scan}
    return {name: module.ORACLE_SQL for name, module in with_sql.items()}
