"""Order steps matched while they arrive: Spark keeps the state between micro-batches.

Two stateful operators of Structured Streaming follow each other: repeats of an event are dropped within the
watermark, then each step is joined to the step that should follow it, as a stream-stream outer join within a limit
of time.  The state lives in Spark's state store below the checkpoint, so a restarted job goes on where it was, and
rows leave it as the watermark passes them: it holds at most the events of (limit + delay), not the history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklake.functions.scalar import utc_of_iso
from sparklake.plans import events as ev
from sparklake.sources.files import path_exists
from sparklake.streaming.events import record_stream

WAITS_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("step_at", T.TimestampNTZType()),
    T.StructField("next_at", T.TimestampNTZType()), T.StructField("seconds", T.DoubleType())])


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _steps(spark: SparkSession, source: str, event_type: str, delay: str, files: int | None) -> DataFrame:
    """(order_id, at) of one kind of event, repeats within ``delay`` dropped; ``at`` is UTC."""
    events = ev.good(ev.decode(record_stream(spark, source, files)))
    utc = F.timestamp_diff("MICROSECOND", _epoch(), utc_of_iso("timestamp"))
    # an instant whatever the session's zone, as watermarks need one
    timed = events.where(F.col("event_type") == event_type).select("event_id", "order_id", F.timestamp_micros(utc).alias("at"))
    return timed.withWatermark("at", delay).dropDuplicatesWithinWatermark(["event_id"]).select("order_id", "at")


def follow(spark: SparkSession, source: str, out: str, checkpoint: str, *, step: str, following: str,
           limit: str = "1 day", delay: str = "2 hours", max_files_per_trigger: int | None = None) -> None:
    """Each ``step`` with the ``following`` step of its order within ``limit`` after it.

    A step whose limit has run out without one comes with NULL as soon as the watermark is past, which is the latest time
    seen of the kind that is behind, less ``delay``; one that may still be followed stays in the state.  An event may arrive ``delay`` late; later
    ones are dropped here by definition (the item table and silver take them whenever they come).
    """
    a = _steps(spark, source, step, delay, max_files_per_trigger).select(F.col("order_id"), F.col("at").alias("step_at"))
    b = _steps(spark, source, following, delay, max_files_per_trigger).select(
        F.col("order_id").alias("next_order"), F.col("at").alias("next_at"))
    within = (F.col("order_id") == F.col("next_order")) & (F.col("next_at") >= F.col("step_at")) & (
        F.col("next_at") <= F.col("step_at") + F.expr(f"INTERVAL {limit}"))
    (a.join(b, within, "left_outer").select("order_id", "step_at", "next_at")
     .writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())


def followed(spark: SparkSession, out: str) -> DataFrame:
    """What ``follow`` has settled so far: (order_id, step_at, next_at, seconds between)."""
    if not path_exists(spark, out):
        return spark.createDataFrame([], WAITS_SCHEMA)
    rows = spark.read.parquet(out)
    utc = [F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch()).alias(c) for c in ("step_at", "next_at")]
    seconds = (F.unix_micros("next_at") - F.unix_micros("step_at")) / F.lit(1_000_000.0)
    return rows.select("order_id", *utc, seconds.alias("seconds"))
