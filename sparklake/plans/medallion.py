"""Bronze -> silver -> gold pipelines for orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparklake.functions.scalar import exact_sum, money, money_digits, round_half_up
from sparklake.operators.cdc import current_state
from sparklake.operators.dedup import dedup_changes
from sparklake.operators.ordered import global_position
from sparklake.session import scratch_path
from sparklake.sources.files import read_parquet, write_parquet


def type_orders(df: DataFrame, now=None, keep=()) -> DataFrame:
    """Cast the text columns of bronze orders; bad text becomes NULL (never an error).
    An amount that is no finite number (NaN, infinity) is bad text."""
    created = F.col("created_at").try_cast("timestamp_ntz")
    cols = [
        F.col("order_id"),
        F.col("customer_id").try_cast("int").alias("customer_id"),
        F.col("product"),
        F.col("quantity").try_cast("int").alias("quantity"),
        money("amount").alias("amount"),
        F.trim(F.upper(F.col("status"))).alias("status"),
        created.alias("created_at"),
        F.col("updated_at").try_cast("timestamp_ntz").alias("updated_at"),
        F.year(created).alias("year"),
        F.month(created).alias("month"),
    ]
    if now is not False:
        cols.append((F.current_timestamp() if now is None else F.lit(now)).alias("processed_at"))
    return df.select(*cols, *keep)


def silver_orders(bronze: DataFrame, now=None, mode: str = "filter") -> DataFrame:
    """K1: drop deletes, one row per order (latest), typed, normalised, stamped.

    ``now=False`` leaves out the ``processed_at`` clock column.
    """
    return type_orders(current_state(bronze, "order_id", mode=mode), now=now)


def silver_changes(bronze: DataFrame) -> DataFrame:
    """One typed row per order of a change batch with its op, deletes kept: what a merge
    needs to apply the batch.  Rows without an op are no changes."""
    return type_orders(dedup_changes(bronze.filter(F.col("op").isNotNull()), "order_id"), now=False, keep=("op",))


def silver_customers(bronze: DataFrame, now=None, mode: str = "filter") -> DataFrame:
    state = current_state(bronze, "customer_id", mode=mode, ts="updated_at")
    cols = [
        F.col("customer_id").try_cast("int").alias("customer_id"),
        "name", "email",
        F.trim(F.upper(F.col("country"))).alias("country"),
        F.col("created_at").try_cast("timestamp_ntz").alias("created_at"),
    ]
    if now is not False:
        cols.append((F.current_timestamp() if now is None else F.lit(now)).alias("processed_at"))
    return state.select(*cols)


def customer_changes(bronze: DataFrame) -> DataFrame:
    """As ``silver_changes``, for customers."""
    latest = dedup_changes(bronze.filter(F.col("op").isNotNull()), "customer_id")
    return latest.select(F.col("customer_id").try_cast("int").alias("customer_id"), "name", "email",
                         F.trim(F.upper(F.col("country"))).alias("country"),
                         F.col("created_at").try_cast("timestamp_ntz").alias("created_at"), "op")


def _money_stats(prefix_total: str, prefix_avg: str):
    return [round_half_up(exact_sum("amount"), 2).alias(prefix_total),
            round_half_up(exact_sum("amount") / F.count("amount"), 2).alias(prefix_avg)]


def _partials(orders: DataFrame, keys) -> DataFrame:
    """Additive partial aggregates per ``keys`` (exact decimal money sums)."""
    return orders.groupBy(*keys).agg(
        F.count("order_id").alias("_n"),
        F.sum(money_digits("amount")).alias("_s"),
        F.count("amount").alias("_na"),
        F.max("created_at").alias("_last"))


def _rolled_money(total: str, avg: str):
    s = F.sum("_s")
    return [round_half_up(s.cast("double"), 2).alias(total),
            round_half_up(s.cast("double") / F.sum("_na"), 2).alias(avg)]


def daily_sales(orders: DataFrame, approx_distinct: bool = False, rsd: float = 0.05) -> DataFrame:
    """K3: revenue KPIs per day.

    Exact form: a two-level aggregate instead of ``count(DISTINCT)`` next to
    other aggregates (which Spark runs through an Expand that doubles the
    rows): first per (day, customer), combined map-side, then per day.  A day
    holding a third of all orders is spread over its customers in the first
    shuffle.  ``approx_distinct=True`` counts customers with HyperLogLog++
    (relative error ``rsd``) in a single pass; the sketches merge map-side.
    """
    day = F.col("created_at").cast("date").alias("date")
    if approx_distinct:
        return orders.groupBy(day).agg(
            F.count("order_id").alias("total_orders"),
            *_money_stats("total_revenue", "avg_order_value"),
            F.approx_count_distinct("customer_id", rsd).alias("unique_customers"))
    return sales_of_days(_partials(orders, [day, "customer_id"]))


def sales_of_days(per: DataFrame) -> DataFrame:
    """Revenue KPIs per day from partial rows by (date, customer)."""
    return per.groupBy("date").agg(
        F.sum("_n").alias("total_orders"),
        *_rolled_money("total_revenue", "avg_order_value"),
        F.count("customer_id").alias("unique_customers"))


def product_totals(orders: DataFrame) -> DataFrame:
    """Product KPIs, one row per product."""
    return orders.groupBy("product").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("quantity").cast("bigint").alias("total_units_sold"),
        *_money_stats("total_revenue", "avg_unit_price"),
        round_half_up(exact_sum("amount") / F.sum("quantity"), 2).alias("true_unit_price"))


def with_revenue_rank(products: DataFrame) -> DataFrame:
    """Dense rank on rounded revenue, highest first: the place of each distinct revenue
    among the distinct ones, counted range by range, so no task holds all products."""
    distinct = products.select(F.col("total_revenue").alias("_revenue")).distinct()
    places = global_position(distinct, [F.col("_revenue").desc()], name="revenue_rank")
    return products.join(places, F.col("total_revenue").eqNullSafe(F.col("_revenue"))).drop("_revenue") \
        .withColumn("revenue_rank", F.col("revenue_rank").cast("bigint"))


def product_ranking(orders: DataFrame) -> DataFrame:
    """K4: product KPIs with a dense rank on rounded revenue.  The totals (a row a product) are
    written once, as the rank reads them several times."""
    path = scratch_path(orders.sparkSession, "product_totals")
    write_parquet(product_totals(orders), path)
    return with_revenue_rank(read_parquet(orders.sparkSession, path))


def _top_from_counts(counts: DataFrame, ties: str) -> DataFrame:
    if ties == "rank":
        w = Window.partitionBy("customer_id").orderBy(F.col("product_orders").desc())
        fn = F.rank()
    else:
        w = Window.partitionBy("customer_id").orderBy(F.col("product_orders").desc(), "product")
        fn = F.row_number()
    return (counts.withColumn("_r", fn.over(w)).filter(F.col("_r") == 1)
                  .select("customer_id", F.col("product").alias("top_product")))


def top_products(orders: DataFrame, ties: str = "rank") -> DataFrame:
    """Most-ordered product per customer; ``ties="rank"`` keeps every tied product."""
    counts = orders.groupBy("customer_id", "product").agg(F.count("order_id").alias("product_orders"))
    return _top_from_counts(counts, ties)


def customer_summary(orders: DataFrame, customers: DataFrame, ties: str = "rank") -> DataFrame:
    """K5: per-customer metrics + attributes + favourite product.

    Orders are reduced once, map-side, to one partial row per (customer,
    product).  A single window pass per customer over those partials yields the
    customer totals and the product rank together; keeping rank 1 gives one row
    per favourite product (ties kept), each carrying the totals.  So the orders
    are scanned and shuffled once, and a customer holding a third of all orders
    is at most #products rows in the window.  A NULL customer keeps one row and
    no favourite, as a join on a NULL key would.
    """
    return summary_of_customers(_partials(orders, ["customer_id", "product"]), customers, ties)


def summary_of_customers(per_cp: DataFrame, customers: DataFrame, ties: str = "rank") -> DataFrame:
    """``customer_summary`` from partial rows by (customer, product)."""
    cust = Window.partitionBy("customer_id")
    by_count = cust.orderBy(F.col("_n").desc())
    first = F.row_number().over(cust.orderBy(F.col("_n").desc(), "product"))
    pick = first if ties != "rank" else F.when(F.col("customer_id").isNull(), first).otherwise(F.rank().over(by_count))
    s_tot = F.sum("_s").over(cust).cast("double")
    summary = per_cp.select(
        "customer_id",
        F.sum("_n").over(cust).alias("total_orders"),
        round_half_up(s_tot, 2).alias("total_spent"),
        round_half_up(s_tot / F.sum("_na").over(cust), 2).alias("avg_order_value"),
        F.max("_last").over(cust).alias("last_order_date"),
        F.when(F.col("customer_id").isNotNull(), F.col("product")).alias("top_product"),
        pick.alias("_r"))
    summary = summary.filter(F.col("_r") == 1).drop("_r")
    attrs = customers.select("customer_id", "name", "email", "country")
    return summary.join(attrs, "customer_id", "left").select(
        "customer_id", "total_orders", "total_spent", "avg_order_value", "last_order_date",
        "name", "email", "country", "top_product")


STATUS_ROLLUP_SQL = """
SELECT status,
       COUNT(*) AS total,
       CAST(ROUND(SUM(CAST(amount AS DECIMAL(38,9))), 2) AS DOUBLE) AS revenue
FROM {table}
GROUP BY status
"""


def silver_status_rollup(orders: DataFrame) -> DataFrame:
    """K7: SQL text over a silver table."""
    return orders.sparkSession.sql(STATUS_ROLLUP_SQL.format(table="{orders}"), orders=orders)
