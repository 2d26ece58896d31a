"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklake.functions import casting as cs
from sparklake.functions.scalar import stable_id
from sparklake.operators import cdc
from sparklake.operators import quality as dq
from sparklake.operators.dedup import latest_by_key
from sparklake.plans import events as ev
from sparklake.plans import flights as fl
from sparklake.plans import medallion as md
from sparklake.plans import scalars as sc
from sparklake.session import scratch_path
from sparklake.sources import adapters as ad
from sparklake.sources.files import read_parquet, write_parquet
from sparklake.sources.tables import TABLES, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _on_flights(fn, **kw) -> Query:
    return lambda spark, sf: fn(ad.load_flights(spark, sf), **kw)


def _on_log(fn, **kw) -> Query:
    return lambda spark, sf: fn(ad.load_system_log(spark, sf), **kw)


for _name, _fn, _kw in [
    ("cancellations_rank", fl.cancellations_rank, {}),
    ("rank_variants", fl.rank_variants, {}),
    ("sliding_occupancy", fl.sliding_occupancy, {}),
    ("sliding_stats", fl.sliding_stats, {}),
    ("range_occupancy", fl.range_occupancy, {}),
    ("mom_change", fl.mom_change, {}),
    ("mom_change_calendar", fl.mom_change, {"calendar": True}),
    ("worsened_over_20", fl.worsened_over, {"threshold": 20}),
    ("lag_default", fl.lag_default, {}),
    ("running_total", fl.running_total, {}),
    ("running_count", fl.running_count, {}),
    ("calendar_activity", fl.calendar_activity, {}),
    ("date_series", fl.date_series, {}),
    ("recursive_date_series", fl.recursive_date_series, {}),
    ("anchored_date_series", fl.route_date_series, {}),
    ("date_series_steps", fl.date_series_steps, {}),
    ("cross_join_grid", fl.route_day_grid, {}),
    ("latest_per_group", fl.latest_per_group, {}),
    ("first_last_cancellation", fl.first_last_cancellation, {}),
    ("distinct_on", fl.last_flight_per_route, {}),
    ("first_last_baseline", fl.first_last_baseline, {}),
    ("nth_value_baseline", fl.nth_value_baseline, {}),
    ("ntile_labels", fl.ntile_labels, {}),
    ("fully_cancelled_days", fl.fully_cancelled_days, {}),
    ("lookback_count_7d", fl.lookback_count, {}),
    ("above_average_rate", fl.above_average_rate, {}),
    ("never_completed", fl.never_completed, {}),
    ("inline_values", fl.status_translation, {}),
    ("filter_between", fl.filter_between, {}),
    ("filter_in", fl.filter_in, {}),
    ("filter_month", fl.filter_month, {}),
]:
    QUERIES[_name] = _on_flights(_fn, **_kw)

for _name, _fn in [("gap_detection", fl.gap_detection), ("gap_report", fl.gap_report),
                   ("gap_summary", fl.gap_summary), ("band_count_36h", fl.signups_before_errors),
                   ("band_range_36h", fl.events_in_reach), ("band_pairs_36h", fl.warned_errors)]:
    QUERIES[_name] = _on_log(_fn)


@register("join_on_expression")
def _join_on_expression(spark, sf):
    return fl.crew_assignment(ad.load_flights(spark, sf),
                              table(spark, sf, "customer", ["c_name", "c_mktsegment"]))


@register("filter_not_equal")
def _filter_not_equal(spark, sf):
    return ad.load_bronze_orders(spark, sf).filter(F.col("op") != "D").select("order_id", "op")


# -- medallion --------------------------------------------------------------
def silver_orders_of(spark, sf, now=False):
    return md.silver_orders(ad.load_bronze_orders(spark, sf), now=now)


def silver_customers_of(spark, sf, now=False):
    return md.silver_customers(ad.load_bronze_customers(spark, sf), now=now)


QUERIES["silver_orders"] = silver_orders_of
QUERIES["silver_customers"] = silver_customers_of
QUERIES["daily_sales"] = lambda spark, sf: md.daily_sales(silver_orders_of(spark, sf))
QUERIES["product_ranking"] = lambda spark, sf: md.product_ranking(silver_orders_of(spark, sf))
QUERIES["customer_summary"] = lambda spark, sf: md.customer_summary(
    silver_orders_of(spark, sf), silver_customers_of(spark, sf))
QUERIES["silver_status_rollup"] = lambda spark, sf: md.silver_status_rollup(silver_orders_of(spark, sf))


@register("generated_ids")
def _generated_ids(spark, sf):
    """Identifiers from a natural key: the same in every run, one a distinct key."""
    bronze = ad.load_bronze_orders(spark, sf)
    return bronze.select("order_id", "op", stable_id("order_id", "op", "created_at").alias("generated_id"))


@register("processed_stamp")
def _processed_stamp(spark, sf):
    """The clock column of silver orders: one time for all rows, between the start of the run and its end."""
    started = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    stamped = silver_orders_of(spark, sf, now=None).select(F.col("processed_at").cast("timestamp").alias("t"))
    in_run = F.coalesce(F.bool_and((F.col("t") >= F.lit(started)) & (F.col("t") <= F.current_timestamp())), F.lit(False))
    return stamped.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("t").alias("stamps"), in_run.alias("in_run"))


# -- change capture -----------------------------------------------------------


def feed_of(spark, sf):
    return cdc.change_feed(ad.load_bronze_orders(spark, sf), ad.load_order_changes(spark, sf),
                           ad.load_order_reinserts(spark, sf))


FEED_COLS = ["order_id", "op", "amount", "updated_at", "commit_seq"]


@register("cdc_full_load")
def _cdc_full_load(spark, sf):
    """Snapshot of every selected table into a replaced target (drop-and-create): the rows
    of each target with the load op, read back."""
    names = cdc.select_tables([f"public.{t}" for t in TABLES], include=[("public", "%")], exclude=["%_tmp"])
    root = scratch_path(spark, "full_load")
    out = None
    for name in (n.split(".")[1] for n in names):  # one job per selected table (catalog metadata, a few names)
        write_parquet(cdc.full_load(table(spark, sf, name)), f"{root}/{name}/load", mode="overwrite")
        loaded = read_parquet(spark, f"{root}/{name}/load")
        one = loaded.agg(F.count_if(F.col("op") == "I").alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(len(loaded.columns)).alias("columns"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


QUERIES["cdc_snapshot_plus_changes"] = lambda spark, sf: feed_of(spark, sf).select(*FEED_COLS)
QUERIES["cdc_inserts_updates"] = lambda spark, sf: cdc.inserts_updates(feed_of(spark, sf)).select(*FEED_COLS)
QUERIES["cdc_current_state"] = lambda spark, sf: md.type_orders(
    cdc.current_state(feed_of(spark, sf), "order_id", mode="apply"), now=False)
QUERIES["cdc_current_state_filter"] = lambda spark, sf: md.type_orders(
    cdc.current_state(feed_of(spark, sf), "order_id", mode="filter"), now=False)


@register("dedup_by_key")
def _dedup_by_key(spark, sf):
    li = table(spark, sf, "lineitem")
    return latest_by_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# -- events ---------------------------------------------------------------------
def decoded_of(spark, sf):
    return ev.decode(ad.load_stream_records(spark, sf))


def items_of(spark, sf):
    return ev.to_items(ev.good(decoded_of(spark, sf)))


QUERIES["event_decode"] = lambda spark, sf: ev.good(decoded_of(spark, sf))
QUERIES["event_dead_letter"] = lambda spark, sf: ev.dead_letter(decoded_of(spark, sf)).select(
    "seq", "partition_key", "reason")
QUERIES["event_batch_counters"] = lambda spark, sf: ev.batch_counters(decoded_of(spark, sf))
QUERIES["event_items"] = items_of


@register("event_upsert")
def _event_upsert(spark, sf):
    """The stream delivered twice; the second time every third record is changed, and some
    come once more with a higher sequence number.  The newest wins, the rest stays."""
    items = ev.to_items(ev.good(decoded_of(spark, sf)), keep=("seq",))
    changed = items.withColumn("amount", F.when(F.col("seq") % 3 == 0, F.lit("777")).otherwise(F.col("amount")))
    again = items.filter(F.col("seq") % 6 == 0).withColumns({
        "status": F.lit("resent"), "seq": F.col("seq") + ad.RESENT_SEQ})
    return ev.upsert_view(items.withColumn("batch_id", F.lit(0)).unionByName(
        changed.unionByName(again).withColumn("batch_id", F.lit(1))))


QUERIES["order_history_range"] = lambda spark, sf: ev.history_range(
    items_of(spark, sf), "2024-01-10", "2024-01-20")
QUERIES["order_current_state"] = lambda spark, sf: ev.current_state(items_of(spark, sf))
QUERIES["lifecycle_violations"] = lambda spark, sf: ev.lifecycle_violations(items_of(spark, sf))
QUERIES["lifecycle_durations"] = lambda spark, sf: ev.lifecycle_durations(items_of(spark, sf))

# -- data quality -------------------------------------------------------------
QUERIES["dq_not_null"] = lambda spark, sf: dq.not_null(ad.load_bronze_orders(spark, sf), key="order_id")
QUERIES["dq_accepted_values"] = lambda spark, sf: dq.accepted_values(
    ad.load_bronze_orders(spark, sf), {"op": ["I", "U", "D"], "product": ["1-URGENT", "2-HIGH", "3-MEDIUM"]},
    key="order_id").unionByName(dq.accepted_values(
        ad.load_order_events(spark, sf), {"event_type": ["order_placed", "order_confirmed",
                                                         "order_shipped", "order_delivered"]},
        key="event_id"))
QUERIES["dq_unique"] = lambda spark, sf: dq.unique(
    table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"]), ["l_orderkey", "l_linenumber"]
).unionByName(dq.unique(table(spark, sf, "orders", ["o_orderkey"]), ["o_orderkey"]))


@register("dq_foreign_key")
def _dq_fk(spark, sf):
    li = table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey"])
    return (dq.foreign_key(li, ["l_orderkey"], table(spark, sf, "orders", ["o_orderkey"]), ["o_orderkey"])
            .unionByName(dq.foreign_key(li, ["l_partkey"], table(spark, sf, "part", ["p_partkey"]), ["p_partkey"]))
            .unionByName(dq.foreign_key(li, ["l_suppkey"], table(spark, sf, "supplier", ["s_suppkey"]), ["s_suppkey"]))
            .unionByName(dq.foreign_key(table(spark, sf, "orders", ["o_custkey"]), ["o_custkey"],
                                        table(spark, sf, "customer", ["c_custkey"]), ["c_custkey"])))


QUERIES["dq_defaults"] = lambda spark, sf: dq.defaults_report(
    ad.load_order_events(spark, sf), {"product": "", "amount": "0"}, key="event_id")
QUERIES["dq_bounds"] = lambda spark, sf: dq.bounds(
    ad.load_bronze_orders(spark, sf), "order_id", max_length={"product": 10, "status": 20},
    decimals={"amount": (10, 2)})

# -- casts ----------------------------------------------------------------------
ORDER_TYPES = {"customer_id": "int", "quantity": "int", "amount": "double",
               "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"}
QUERIES["typed_cast"] = lambda spark, sf: cs.cast_rejects(ad.load_bronze_orders(spark, sf), ORDER_TYPES)
QUERIES["resolve_choice"] = lambda spark, sf: cs.resolve_choice(
    ad.load_order_events(spark, sf).select("event_id", "amount", "product"),
    {"amount": ("double", "cast"), "product": ("double", "split")})
ORDER_MAPPING = [("order_id", "string", "order_key", "bigint"),
                 ("customer_id", "string", "customer_key", "int"),
                 ("amount", "string", "amount_value", "double"),
                 ("created_at", "string", "created_ts", "timestamp_ntz")]
QUERIES["apply_mapping"] = lambda spark, sf: cs.apply_mapping(ad.load_bronze_orders(spark, sf), ORDER_MAPPING)

# -- scalar groups ------------------------------------------------------------
QUERIES["scalar_string"] = lambda spark, sf: sc.string_functions(ad.load_bronze_customers(spark, sf))
QUERIES["scalar_datetime"] = lambda spark, sf: sc.datetime_functions(ad.load_system_log(spark, sf))
QUERIES["scalar_numeric"] = lambda spark, sf: sc.numeric_functions(
    table(spark, sf, "orders", ["o_orderkey", "o_totalprice", "o_custkey"]))
QUERIES["scalar_conditional"] = lambda spark, sf: sc.conditional_functions(ad.load_order_events(spark, sf))
QUERIES["scalar_json"] = lambda spark, sf: sc.json_functions(ad.load_stream_records(spark, sf))


@register("table_counts")
def _table_counts(spark, sf):
    parts = [("flights", ad.load_flights(spark, sf)), ("system_log", ad.load_system_log(spark, sf)),
             ("bronze_orders", ad.load_bronze_orders(spark, sf)),
             ("bronze_customers", ad.load_bronze_customers(spark, sf)),
             ("order_events", ad.load_order_events(spark, sf))]
    out = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


@register("in_exists_join_equivalence")
def _in_exists(spark, sf):
    return fl.in_exists_join_equivalence(ad.load_flights(spark, sf),
                                         table(spark, sf, "customer", ["c_custkey"]))
