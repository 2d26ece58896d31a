"""Order-event stream as DataFrame transforms (same code for batch and stream).

records(seq, partition_key, data) --decode--> events + reason
events --to_items--> keyed items (PK, SK, GSI1PK, GSI1SK, attributes)
items --upsert_view--> latest item per (PK, SK)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparklake.functions.json import (
    OPTIONAL_DEFAULTS, ORDER_EVENT_SCHEMA, REQUIRED_FIELDS, decode_base64_text,
    field_or_default, json_map)
from sparklake.functions.scalar import CANCEL_AFTER, ORDER_LIFECYCLE, micros_between, utc_of_iso
from sparklake.operators.dedup import latest_by_key
from sparklake.operators.ordered import keyed_shift
from sparklake.sources.files import with_file_rows

UNDECODABLE = "undecodable_payload"
NOT_JSON = "malformed_json"


def decode(records: DataFrame) -> DataFrame:
    """Decode every record; ``reason`` is NULL for good rows, else why it failed.

    The JSON is parsed once, into a text map (values and key presence from one
    parse).  The decoded record is emitted through a one-element ``inline``
    generator: predicates on its fields (``reason IS NULL``) stay above the
    generator, so base64 and JSON parsing run once per row instead of being
    re-inlined into every pushed-down filter.
    """
    text = decode_base64_text("data")
    d = records.select("seq", "partition_key", "data", text.alias("_text"))
    d = d.select("seq", "partition_key", "data", F.col("_text").isNull().alias("_undecodable"),
                 json_map("_text").alias("_evt"))
    evt = F.col("_evt")
    reason = (F.when(F.col("_undecodable"), F.lit(UNDECODABLE))
               .when(evt.isNull(), F.lit(NOT_JSON)))
    for f in REQUIRED_FIELDS:
        reason = reason.when(evt[f].isNull(), F.lit(f"missing_{f}"))
    fields = []
    for f in ORDER_EVENT_SCHEMA.fieldNames():
        if f in OPTIONAL_DEFAULTS:
            fields.append(field_or_default(evt, f, OPTIONAL_DEFAULTS[f]).alias(f))
        else:
            fields.append(evt[f].alias(f))
    rec = F.struct(*fields, reason.alias("reason"))
    return d.select("seq", "partition_key", "data", F.inline(F.array(rec)))


def good(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNull()).drop("reason", "data")


def dead_letter(decoded: DataFrame) -> DataFrame:
    """Rows that could not be processed, kept with their payload and the reason."""
    return decoded.filter(F.col("reason").isNotNull()).select("seq", "partition_key", "data", "reason")


def batch_counters(decoded: DataFrame) -> DataFrame:
    """processed / failed counts in one pass."""
    return decoded.agg(F.count_if(F.col("reason").isNull()).alias("processed"),
                       F.count_if(F.col("reason").isNotNull()).alias("failed"))


def to_items(events: DataFrame, keep=()) -> DataFrame:
    """Single-table item layout: partition key per order, sort key by time and type,
    a secondary key per customer.  ``keep`` names columns to carry along, such as the
    record's ``seq``."""
    return events.select(
        F.concat(F.lit("ORDER#"), "order_id").alias("pk"),
        F.concat(F.lit("EVENT#"), "timestamp", F.lit("#"), "event_type").alias("sk"),
        F.concat(F.lit("CUSTOMER#"), "customer_id").alias("gsi1pk"),
        F.col("timestamp").alias("gsi1sk"),
        "event_id", "order_id", "customer_id", "event_type", "product", "amount", "status",
        "timestamp", *keep)


def upsert_view(batches: DataFrame) -> DataFrame:
    """Latest item per (pk, sk) across batches: replays and repeats overwrite.

    ``batches`` carries ``batch_id`` and ``seq``; the newest batch wins, then the
    newest record.  The pick keeps one row a key and task before the shuffle.
    """
    latest = latest_by_key(batches, ["pk", "sk"], ["batch_id", "seq"])
    return latest.drop("batch_id", "seq")


BUCKETS = 64


def _bucket(key, buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def store(items: DataFrame, path: str, key: str, sort: list[str], buckets: int = BUCKETS) -> None:
    """Write an access path: all attributes, a folder per hash bucket of ``key``, rows in the
    order of (key, sort).  Range partitioning splits a heavy key over several files."""
    b = items.withColumn("bucket", _bucket(key, buckets))
    (b.repartitionByRange("bucket", key, *sort).sortWithinPartitions("bucket", key, *sort)
      .write.mode("overwrite").partitionBy("bucket").parquet(path))


def stored(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A stored access path, with each row's position inside its key as the files have it.

    In a file the rows of a key follow each other, so a row's position is its number in the file less that of
    the key's first row there, and the key's rows in earlier files: prefix sums over one row a (file, key).
    """
    rows = with_file_rows(spark, path)
    runs = rows.groupBy("_file", key).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    before = Window.partitionBy(key).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("_file", key, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    placed = rows.join(offsets, ["_file", key])
    return placed.select(*[c for c in rows.columns if c not in ("_file", "_at", "bucket")],
                         (F.col("_at") + F.col("_shift") + 1).alias("position"))


def lookup(spark: SparkSession, path: str, key: str, value: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows of one key: reads one bucket folder, with the key pushed to its files."""
    rows = spark.read.parquet(path)
    return rows.filter((F.col("bucket") == _bucket(F.lit(value), buckets)) & (F.col(key) == value)).drop("bucket")


def history_of(spark: SparkSession, path: str, order_id: str) -> DataFrame:
    """One order's history in sort-key order (point lookup in the path stored by pk)."""
    return lookup(spark, path, "pk", f"ORDER#{order_id}").orderBy("sk")


def history_range(items: DataFrame, start: str, end: str) -> DataFrame:
    """Sort-key range: events whose SK falls in [EVENT#start, EVENT#end)."""
    lo, hi = "EVENT#" + start, "EVENT#" + end
    return items.filter((F.col("sk") >= lo) & (F.col("sk") < hi)).select("pk", "sk", "event_type")


def current_state(items: DataFrame) -> DataFrame:
    """The latest event of each order decides its status."""
    last = latest_by_key(items.select("order_id", "sk", "event_type", "status", "timestamp"),
                         ["order_id"], ["sk"])
    return last.select("order_id", "event_type", "status", F.col("timestamp").alias("last_timestamp"))


def allowed_transitions() -> list[tuple[str | None, str]]:
    steps = [(None, ORDER_LIFECYCLE[0])]
    steps += list(zip(ORDER_LIFECYCLE[:-1], ORDER_LIFECYCLE[1:]))
    steps.append((CANCEL_AFTER, "order_cancelled"))
    return steps


def _with_previous(items: DataFrame) -> DataFrame:
    base = items.select("order_id", "sk", "event_type", "timestamp")
    return keyed_shift(base, ["order_id"], ["sk"], ["event_type", "timestamp"], direction="lag")


def lifecycle_violations(items: DataFrame) -> DataFrame:
    """Steps that break placed -> confirmed -> shipped -> delivered (or a cancel after
    confirmation).  The previous step comes from a keyed lag that splits heavy orders."""
    ok = F.lit(False)
    for prev, cur in allowed_transitions():
        prev_ok = F.col("prev_event_type").isNull() if prev is None else (F.col("prev_event_type") == prev)
        ok = ok | (prev_ok & (F.col("event_type") == cur))
    return (_with_previous(items).filter(~ok)
            .select("order_id", "prev_event_type", "event_type", "timestamp"))


def lifecycle_durations(items: DataFrame) -> DataFrame:
    """Seconds between consecutive events of an order."""
    p = _with_previous(items)
    secs = micros_between(utc_of_iso("prev_timestamp"), utc_of_iso("timestamp")) / F.lit(1_000_000.0)
    return p.select("order_id", "event_type", "prev_event_type", secs.alias("seconds_since_prev"))
