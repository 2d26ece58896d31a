"""Scalar-function showcases over the adapter tables (one query per group)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklake.functions.scalar import (
    clock_time, dow_sunday0, epoch_minutes_between, iso_ms, month_start, round_half_up,
    status_of_event, year_month)
from sparklake.plans import events as ev


def string_functions(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        F.trim(F.upper("country")).alias("country_norm"),
        F.substring("name", 1, 3).alias("name_prefix"),
        F.concat(F.lit("CUSTOMER#"), "customer_id").alias("item_key"),
        F.concat_ws("|", "customer_id", "email").alias("joined"))


def datetime_functions(log: DataFrame) -> DataFrame:
    day = F.col("ts").cast("date")
    return log.select(
        "event_id",
        year_month("ts").alias("year_month"),
        clock_time("ts").alias("clock"),
        month_start("ts").alias("month_start"),
        F.dayofmonth("ts").alias("day"),
        F.month("ts").alias("month"),
        F.year("ts").alias("year"),
        dow_sunday0("ts").alias("dow"),
        epoch_minutes_between(day.cast("timestamp_ntz"), "ts").alias("minutes_since_midnight"),
        F.date_add(day, 7).alias("plus_7d"),
        F.date_sub(day, 7).alias("minus_7d"),
        iso_ms("ts").alias("iso_ts"))


def numeric_functions(orders: DataFrame) -> DataFrame:
    return orders.select(
        "o_orderkey",
        round_half_up(F.col("o_totalprice") / 7, 2).alias("price_div_7"),
        (F.col("o_orderkey") % 7).alias("key_mod_7"),
        (F.col("o_totalprice") * 2).alias("price_x2"),
        (F.col("o_custkey") + 1).alias("cust_plus_1"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("price_thousands"),
        (F.col("o_custkey") / 3).alias("cust_div_3"))


def conditional_functions(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        status_of_event("event_type").alias("status_lookup"),
        F.coalesce("amount", F.lit("0")).alias("amount_or_zero"),
        F.nullif(F.col("customer_id"), F.lit(0)).alias("customer_or_null"),
        F.when(F.col("product").isNull(), "missing")
         .when(F.col("event_type") == "order_cancelled", "cancel")
         .otherwise("ok").alias("note"))


def json_functions(records: DataFrame) -> DataFrame:
    d = ev.decode(records)
    return d.select("seq", "event_id", "event_type", "product", "amount", "reason")
