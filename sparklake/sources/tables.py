"""Loaders for the input tables (one Parquet dataset per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Read one table; ``columns`` prunes the Parquet read schema up front."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
