"""Training-corpus pipeline: five stages over the documents table, each one operator of sparklake.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklake.llm import exact_dedup, near_join, quality_rules, sentencepiece_bpe, source_mix
from sparklake.llm.common import save


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a shingle similarity of 0.8 or more."""
    return near_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it."""
    return source_mix.mixed(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document's text, their number, and in place of the text what the ids decode to."""
    both = sentencepiece_bpe.encode(docs, carry_text=False, decoded=True)
    return both.withColumnRenamed("decoded", "text").withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("near_join", near), ("source_mix", mix),
          ("sentencepiece", pieces)]

#: Robust outliers and BPE are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
