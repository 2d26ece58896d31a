"""Registered queries of the subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from sparklake.llm import (exact_dedup, near_join, periodic_runs, pii, quality_model, quality_rules, secret_scan,
                           sentencepiece_bpe, sharding, source_mix, spelling, token_counts, word_bpe)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _on_documents(digest: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: digest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mix": _on_documents(source_mix.digest),
    "op2_token_counts": _on_documents(token_counts.digest),
    "op3_sharding": _on_documents(sharding.digest),
    "op4_quality_model": lambda spark, sf_dir: quality_model.scored(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")),
    "op5_secret_scan": _on_documents(secret_scan.digest),
    "op6_pii": _on_documents(pii.digest),
    "op7_near_join": _on_documents(near_join.digest),
    "op8_sentencepiece": _on_documents(sentencepiece_bpe.digest),
    "op9_exact_dedup": _on_documents(exact_dedup.digest),
    "op10_quality_rules": _on_documents(quality_rules.digest),
    "op11_word_bpe": _on_documents(word_bpe.digest),
    "op12_periodic_runs": _on_documents(periodic_runs.digest),
    "op13_spelling": _on_documents(spelling.digest),
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op5_secret_scan": secret_scan.ORACLE,
    "op9_exact_dedup": exact_dedup.ORACLE,
}
