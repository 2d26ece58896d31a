"""Adapter views: the driver's tables re-shaped into the pipeline inputs.

Each builder takes the source DataFrame(s) and returns a DataFrame; the
``load_*`` wrappers read only the needed columns from Parquet.  The same
views are written in SQL in ``plans.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklake.functions.scalar import iso_ms, status_of_event
from sparklake.sources.tables import table

# Order status code -> flight status.
FLIGHT_STATUS = {"P": "CANCELLED", "O": "DELAYED", "F": "COMPLETED"}
FLIGHT_CAPACITY = 100


def _status_map(mapping: dict) -> F.Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)


# -- flights (stands for the flight table) ----------------------------------
def flights(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("route"),
        F.col("o_orderdate").cast("date").alias("flight_date"),
        _status_map(FLIGHT_STATUS)[F.col("o_orderstatus")].alias("status"),
        F.floor(F.col("o_totalprice") / 5000).cast("int").alias("passengers"),
        F.lit(FLIGHT_CAPACITY).alias("capacity"),
        F.col("o_custkey").alias("carrier"),
    )


def load_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights(table(spark, sf_dir, "orders", [
        "o_orderkey", "o_orderpriority", "o_orderdate", "o_orderstatus",
        "o_totalprice", "o_custkey"]))


# -- system_log (stands for the system event log) ---------------------------
def system_log(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "ts", "user_id",
        F.col("event_type").alias("system"),
        F.when(F.col("event_type") == "error", "ERROR")
         .when(F.col("event_type") == "signup", "WARN")
         .otherwise("INFO").alias("severity"),
    )


def load_system_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return system_log(table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"]))


# -- bronze orders: every column text, with a change-capture op -------------
def _op_code(key: F.Column) -> F.Column:
    return (F.when(key % 50 == 7, F.lit(None).cast("string"))
             .when(key % 10 == 0, "D")
             .when(key % 10 <= 3, "U")
             .otherwise("I"))


def _amount_text(key: F.Column) -> F.Column:
    """Amounts as sources send them: below a cent, very large, no number, no text of a number."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return (F.when(key % 97 == 11, "0.004").when(key % 97 == 12, "NaN").when(key % 97 == 13, "1234567.25")
             .when(key % 97 == 14, "abc").otherwise(price))


def bronze_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    date = F.col("o_orderdate").cast("string")
    created = F.when(k % 89 == 5, "not a date").when(k % 89 != 6, date)
    return orders.select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("product"),
        (F.lit(1) + k % 5).cast("string").alias("quantity"),
        _amount_text(k).alias("amount"),
        F.concat(F.lit(" "), F.lower("o_orderstatus"), F.lit(" ")).alias("status"),
        created.alias("created_at"),
        F.when(k % 89 != 7, created).alias("updated_at"),
        _op_code(k).alias("op"),
    )


def _changed(orders: DataFrame, amount: F.Column, updated: F.Column, op: F.Column) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("product"),
        (F.lit(1) + k % 5).cast("string").alias("quantity"),
        (F.col("o_totalprice").cast("decimal(18,2)") + amount).cast("decimal(18,2)")
            .cast("string").alias("amount"),
        F.concat(F.lit(" "), F.lower("o_orderstatus"), F.lit(" ")).alias("status"),
        F.col("o_orderdate").cast("string").alias("created_at"),
        updated.cast("string").alias("updated_at"),
        op.alias("op"),
    )


def order_changes(orders: DataFrame) -> DataFrame:
    """Second capture file: updates and deletes a day later, some at the very time of the
    snapshot's row (with a lower amount), some deletes without a time."""
    k, date = F.col("o_orderkey"), F.col("o_orderdate")
    sel = orders.filter((k % 20 == 3) | (k % 20 == 6))
    updated = (F.when((k % 40 == 3) | (k % 40 == 26), date)
                .when(k % 40 != 6, date + F.expr("INTERVAL 1 DAY")))
    return _changed(sel, F.when(k % 40 == 3, F.lit(-1)).otherwise(F.lit(1)), updated,
                    F.when(k % 20 == 3, "U").otherwise("D"))


def order_reinserts(orders: DataFrame) -> DataFrame:
    """Third capture file: some deleted orders come back at the time of their delete."""
    k = F.col("o_orderkey")
    return _changed(orders.filter(k % 80 == 26), F.lit(5), F.col("o_orderdate"), F.lit("I"))


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice",
               "o_orderstatus", "o_orderdate"]


def load_bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_orders(table(spark, sf_dir, "orders", _ORDER_COLS))


def load_order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_changes(table(spark, sf_dir, "orders", _ORDER_COLS))


def load_order_reinserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_reinserts(table(spark, sf_dir, "orders", _ORDER_COLS))


# -- bronze customers -------------------------------------------------------
CUSTOMER_CREATED_AT = "2024-01-01 00:00:00"


def bronze_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    # nation has one row per key (25 rows): the join is a lookup.
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
    return joined.select(
        k.cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("country"),
        F.lit(CUSTOMER_CREATED_AT).alias("created_at"),
        F.when(k % 25 == 0, "D").otherwise("I").alias("op"),
    )


def load_bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_customers(
        table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"]),
        table(spark, sf_dir, "nation", ["n_nationkey", "n_name"]))


def customer_changes(customers: DataFrame) -> DataFrame:
    """Second customer file: new mail addresses, and deletes."""
    k = F.col("customer_id").cast("bigint")
    return customers.filter(k % 20 <= 1).withColumns({
        "email": F.concat(F.lit("new."), F.col("email")), "op": F.when(k % 20 == 0, "U").otherwise("D")})


# -- order events (plain columns) and their encoded stream records ----------
def order_events(events: DataFrame) -> DataFrame:
    # order number and lifecycle step are computed once, then referenced
    base = events.select("event_id", "ts", "value", "props",
                         F.floor(F.col("event_id") / 4).cast("bigint").alias("_ord"),
                         (F.col("event_id") % 4).alias("_kind"))
    eid, ord_, kind = F.col("event_id"), F.col("_ord"), F.col("_kind")
    keep = ~((kind == 3) & (ord_ % 5 == 0) & (ord_ % 7 != 0))
    etype = (F.when(kind == 0, "order_placed")
              .when(kind == 1, "order_confirmed")
              .when((kind == 2) & (ord_ % 5 == 0), "order_cancelled")
              .when(kind == 2, "order_shipped")
              .otherwise("order_delivered"))
    return base.filter(keep).select(
        eid.alias("event_id"),
        F.concat(F.lit("o"), ord_.cast("string")).alias("order_id"),
        (ord_ % 50).alias("customer_id"),
        etype.alias("event_type"),
        F.when(eid % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("props")).alias("product"),
        F.when(eid % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("value").cast("string")).alias("amount"),
        iso_ms("ts").alias("timestamp"),
        (eid % 97 == 5).alias("is_corrupt"),
        (eid % 101 == 3).alias("misses_order_id"),
        status_of_event(etype).alias("status"))


def load_order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events(table(spark, sf_dir, "events", ["event_id", "ts", "value", "props"]))


def stream_records(events: DataFrame) -> DataFrame:
    """Encode order events as broker records: (seq, partition_key, data).

    ``data`` is base64 of the JSON event; NULL fields vanish from the JSON
    (missing key), corrupt records carry text that is not base64.
    """
    body = F.struct(
        F.md5(F.col("event_id").cast("string")).alias("event_id"),  # sources send text ids
        F.when(~F.col("misses_order_id"), F.col("order_id")).alias("order_id"),
        "customer_id", "event_type", "product", "amount", "status", "timestamp")
    payload = F.base64(F.encode(F.to_json(body), "UTF-8"))
    return events.select(
        (F.col("seq") if "seq" in events.columns else F.col("event_id")).alias("seq"),
        F.col("order_id").alias("partition_key"),
        F.when(F.col("is_corrupt"), F.lit("%%not-base64%%")).otherwise(payload).alias("data"),
    )


RESENT_SEQ = 1_000_000_000


def late_arrivals(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Order events in two landings (seq, then the event columns): a fifth arrives hours late,
    some of it with a zone offset in its time, and some of the first come again, changed."""
    k = F.col("event_id")
    first = events.filter(k % 5 != 0).withColumn("seq", k)
    utc = F.col("timestamp").try_cast("timestamp")
    shifted = F.concat(F.date_format(F.to_utc_timestamp(utc, F.current_timezone()) + F.expr("INTERVAL 2 HOURS"),
                                     "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+02:00"))
    late = events.filter(k % 5 == 0).withColumn("seq", k).withColumn(
        "timestamp", F.when(k % 10 == 5, shifted).otherwise(F.col("timestamp")))
    again = events.filter(k % 10 == 1).withColumn("seq", k + RESENT_SEQ).withColumn("amount", F.lit("999"))
    return first, late.unionByName(again)


def load_stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_records(load_order_events(spark, sf_dir))
