"""Tables that are written once, and broadcasts of a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sparklake.session import scratch_path

#: Narrow rows that a side may have to be broadcast.
BROADCAST_ROWS = 500_000


def written(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` written once below the shared checkpoint folder, and its number of rows, counted on the way."""
    path, seen = scratch_path(df.sparkSession, name), Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get.get("rows", 0)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` written once, with a broadcast hint if it has at most ``limit`` rows, else without
    (a shuffle join, whose hot keys AQE splits).  Meant for aggregates: they are computed once."""
    held, rows = written(df, "small")
    return F.broadcast(held) if rows <= limit else held
