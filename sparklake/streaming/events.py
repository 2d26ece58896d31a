"""Order-event stream jobs: ingest with dead letters, idempotent keyed upsert,
hourly raw landing, de-duplicated silver refresh, touched-day gold refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from sparklake import schemas
from sparklake.functions.scalar import utc_of_iso
from sparklake.operators.dedup import latest_by_key
from sparklake.plans import events as ev
from sparklake.sources.files import drop_parts, path_exists, read_parquet, with_date_parts, write_parquet

ITEM_COLUMNS = ("pk", "sk", "gsi1pk", "gsi1sk", "event_id", "order_id", "customer_id", "event_type",
                "product", "amount", "status", "timestamp")
HOUR_PARTS = ("year", "month", "day", "hour")
_ITEM_FIELDS = [T.StructField(c, T.StringType()) for c in ITEM_COLUMNS] + [T.StructField("seq", T.LongType())]
BATCH_SCHEMA = T.StructType([*_ITEM_FIELDS, *[T.StructField(c, T.StringType()) for c in ("partition_key", "data", "reason", "kind")],
                             T.StructField("batch_id", T.IntegerType())])
COUNTERS_SCHEMA = T.StructType([T.StructField("batch_id", T.IntegerType()), T.StructField("processed", T.LongType()),
                                T.StructField("failed", T.LongType())])
ITEMS, DEAD_LETTERS = "items", "dead_letter"
# Landing zone: item columns plus zero-padded text partitions (never re-inferred as numbers).
LANDING_SCHEMA = T.StructType(_ITEM_FIELDS + [T.StructField(c, T.StringType()) for c in HOUR_PARTS])
#: Folder names of events whose time is no time.
NO_TIME = "unknown"


def record_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Broker records landed as Parquet files (the source is a parameter; a
    broker connector such as Kafka yields the same three columns)."""
    r = spark.readStream.schema(schemas.STREAM_RECORD)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(source)


def ingest(spark: SparkSession, source: str, out: str, checkpoint: str, *,
           max_files_per_trigger: int | None = None, start: str = "earliest") -> None:
    """Decode each micro-batch once; its items go to ``out/batches/kind=items/batch_id=<n>``, its dead letters to
    ``out/batches/kind=dead_letter/batch_id=<n>`` and its counts, observed while these are written, to
    ``out/counters/batch_id=<n>``.  A replayed batch overwrites its own folders, so the upsert is idempotent.

    ``start="latest"`` skips the files already present when the consumer starts for
    the first time (no checkpoint yet): one run commits them to the checkpoint and
    discards their rows.  Whatever lands later is processed, whatever its sequence number.

    A batch is dealt out by ``seq`` before it is decoded, however few files and row groups it came in: a task
    sorts what it writes by kind, and would else sort a whole row group.
    """
    records = record_stream(spark, source, max_files_per_trigger)

    def run(sink_batch) -> None:
        (records.writeStream.foreachBatch(sink_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())

    def sink_batch(batch: DataFrame, batch_id: int) -> None:
        seen, bad = Observation(), F.col("reason").isNotNull()
        rows = ev.to_items(ev.decode(batch.hint("rebalance", "seq")), keep=("seq", "partition_key", "data", "reason")).withColumns({
            "kind": F.when(bad, DEAD_LETTERS).otherwise(ITEMS), "batch_id": F.lit(batch_id).cast("int"),
            "data": F.when(bad, F.col("data"))})
        counted = rows.observe(seen, F.count_if(~bad).alias("processed"), F.count_if(bad).alias("failed"))
        (counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("kind", "batch_id").parquet(f"{out}/batches"))
        counts = seen.get
        one = spark.createDataFrame([(batch_id, counts.get("processed") or 0, counts.get("failed") or 0)], COUNTERS_SCHEMA)
        write_parquet(one.drop("batch_id"), f"{out}/counters/batch_id={batch_id}")

    if start == "latest" and not path_exists(spark, checkpoint):
        run(lambda batch, batch_id: None)
    run(sink_batch)


def _batches(spark: SparkSession, out: str, kind: str) -> DataFrame:
    path = f"{out}/batches"
    if not path_exists(spark, path):
        return spark.createDataFrame([], BATCH_SCHEMA)
    return spark.read.schema(BATCH_SCHEMA).parquet(path).where(F.col("kind") == kind)


def item_view(spark: SparkSession, out: str) -> DataFrame:
    """Current items: the latest version of each (pk, sk) over all batches."""
    return ev.upsert_view(_batches(spark, out, ITEMS).select(*ITEM_COLUMNS, "seq", "batch_id"))


def dead_letters(spark: SparkSession, out: str) -> DataFrame:
    """The records of all batches that could not be decoded, with their payload and the reason."""
    return _batches(spark, out, DEAD_LETTERS).select("batch_id", "seq", "partition_key", "data", "reason")


def batch_counters(spark: SparkSession, out: str) -> DataFrame:
    """(batch_id, processed, failed) of each batch, as observed in the pass that wrote it."""
    path = f"{out}/counters"
    if not path_exists(spark, path):
        return spark.createDataFrame([], COUNTERS_SCHEMA)
    return spark.read.schema(COUNTERS_SCHEMA).parquet(path).select(*COUNTERS_SCHEMA.fieldNames())


def land_hourly(spark: SparkSession, source: str, landing: str, checkpoint: str) -> None:
    """Raw landing zone: decoded good events under year=/month=/day=/hour= of their UTC time.

    A task sorts its rows by hour to write them, so they are dealt out by hour and, for hours that hold much, by the split
    they come from: no more of an hour meets in a task than was in one split, and no hour has more files than splits.
    """
    good = ev.to_items(ev.good(ev.decode(record_stream(spark, source))), keep=("seq",))
    parts = with_date_parts(good.withColumn("_ts", utc_of_iso("timestamp")), "_ts", HOUR_PARTS).drop("_ts")
    parts = parts.withColumns({p: F.coalesce(p, F.lit(NO_TIME)) for p in HOUR_PARTS})
    parts = parts.withColumn("_split", F.spark_partition_id()).repartition(*HOUR_PARTS, "_split").drop("_split")
    (parts.writeStream.format("parquet").option("path", landing)
     .option("checkpointLocation", checkpoint).partitionBy(*HOUR_PARTS)
     .trigger(availableNow=True).start().awaitTermination())


def refresh_silver(spark: SparkSession, landing: str, silver: str, checkpoint: str) -> None:
    """Hourly silver refresh over the landing zone: one row per (pk, sk), the newest record.

    Each batch rewrites the hours it touches from what silver has there and the batch,
    so a row may arrive any time late; replaying a batch gives the same hours.
    """
    raw = spark.readStream.schema(LANDING_SCHEMA).parquet(landing)
    hour_of = F.concat_ws("/", *HOUR_PARTS)

    def merge_hours(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        if path_exists(spark, silver):
            # the touched hours as a literal, so that only their folders are listed and read
            hours = [r["h"] for r in batch.select(hour_of.alias("h")).distinct().collect()]
            there = spark.read.schema(LANDING_SCHEMA).parquet(silver).where(hour_of.isin(hours))
            rows = there.select(*batch.columns).unionByName(batch)
        write_parquet(latest_by_key(rows, ["pk", "sk"], ["seq"]), silver, partition_by=HOUR_PARTS, dynamic=True)

    (raw.writeStream.foreachBatch(merge_hours)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def refresh_gold(silver: DataFrame, touched: DataFrame, gold_path: str, build, silver_part, gold_part) -> None:
    """Recompute gold rows only for the parts that a new batch touched.

    ``silver_part`` gives each silver row's part, ``gold_part`` each gold row's; ``build`` maps
    the silver rows of some parts to exactly the gold rows of these parts.  Gold is stored by ``part`` and
    overwritten dynamically: touched parts are rebuilt from silver, all others stay as they
    are, and a touched part that has no rows any more goes.  NULL is a part like any other.
    """
    spark = silver.sparkSession
    wanted = {r[0] for r in touched.select(touched.columns[0]).distinct().collect()}  # parts of gold, not rows
    scope = silver.where(F.when(silver_part.isNull(), F.lit(None in wanted))
                          .otherwise(silver_part.isin([p for p in wanted if p is not None])))
    write_parquet(build(scope).withColumn("part", gold_part), gold_path, mode="overwrite", partition_by=["part"],
                  dynamic=True)
    left = {r[0] for r in scope.select(silver_part).distinct().collect()}
    drop_parts(spark, gold_path, "part", wanted - left)


def month_of(date) -> F.Column:
    return F.date_format(F.col(date).cast("date"), "yyyy-MM")


def key_bucket(key: str, buckets: int = 64) -> F.Column:
    """Part of a gold table that is keyed by something else than a date."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path).drop("part")
