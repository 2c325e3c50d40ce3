"""The registered query of each operator, over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blockspark.llm import decontamination, html_extract, pieces, quality_classifier, quality_rules, secrets, simhash, suffix_dedup, token_shards, toxicity
from blockspark.llm.common import table
from blockspark.session import shared_dir


def op1_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.digest(toxicity.score(docs, model))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.repeated_spans(table(spark, sf_dir, "documents")))


def op4_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.digest(quality_classifier.score(docs, forest))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(quality_rules.judge(table(spark, sf_dir, "documents")))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark).rstrip('/')}/token-shards-{uuid.uuid4().hex}"
    return token_shards.write_shards(table(spark, sf_dir, "documents"), folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_benchmark_leaks": op1_benchmark_leaks,
        "op2_toxicity": op2_toxicity,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_piece_encoding": op4_piece_encoding,
        "op5_secret_scan": op5_secret_scan,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_html_extract": op7_html_extract,
        "op8_quality_rules": op8_quality_rules,
        "op9_simhash_near_dedup": op9_simhash_near_dedup,
        "op10_token_shards": op10_token_shards,
    }


def oracle_sql() -> dict[str, str]:
    return {}
