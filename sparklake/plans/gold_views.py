"""Gold of orders as views of a merged table: partial rows by key and month, kept up by what each batch changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklake.functions.scalar import round_half_up
from sparklake.plans import medallion as md
from sparklake.streaming.merge import Merged, View

ORDER_FIELDS = T.StructType([T.StructField(name, kind) for name, kind in (
    ("order_id", T.StringType()), ("customer_id", T.IntegerType()), ("product", T.StringType()), ("quantity", T.IntegerType()),
    ("amount", T.DoubleType()), ("status", T.StringType()), ("created_at", T.TimestampNTZType()),
    ("updated_at", T.TimestampNTZType()), ("year", T.IntegerType()), ("month", T.IntegerType()))])


def merged_orders(root: str, buckets: int = 64) -> Merged:
    """Silver orders by month of creation."""
    return Merged(root, "order_id", "date_format(created_at, 'yyyy-MM')", ORDER_FIELDS, buckets)


_MONEY = {"_n": ("IF(order_id IS NULL, 0, 1)", "bigint"), "_s": ("amount", "decimal(38,9)"),
          "_na": ("IF(amount IS NULL, 0, 1)", "bigint")}
DAYS = View("days", {"date": ("created_at", "date"), "customer_id": ("customer_id", "int")}, _MONEY)
PRODUCTS = View("products", {"product": ("product", "string")},
                {**_MONEY, "_u": ("quantity", "bigint"), "_nu": ("IF(quantity IS NULL, 0, 1)", "bigint")})
CUSTOMERS = View("customers", {"customer_id": ("customer_id", "int"), "product": ("product", "string")}, _MONEY,
                 {"_last": ("created_at", "timestamp_ntz")})


def _rolled(view: View, spark: SparkSession, orders: Merged) -> DataFrame:
    """The view's partial rows over all months; a sum of nothing is NULL."""
    rows = view.read(spark, orders).groupBy(*view.keys).agg(
        *[F.sum(n).alias(n) for n in view.sums], *[F.max(n).alias(n) for n in view.highs])
    return rows.withColumn("_s", F.when(F.col("_na") > 0, F.col("_s")))


def daily_sales(spark: SparkSession, orders: Merged) -> DataFrame:
    """K3 from DAYS."""
    return md.sales_of_days(_rolled(DAYS, spark, orders))


def customer_summary(spark: SparkSession, orders: Merged, customers: DataFrame, ties: str = "rank") -> DataFrame:
    """K5 from CUSTOMERS."""
    return md.summary_of_customers(_rolled(CUSTOMERS, spark, orders), customers, ties)


def product_totals(spark: SparkSession, orders: Merged) -> DataFrame:
    """Product KPIs from PRODUCTS; ``medallion.with_revenue_rank`` makes K4 of them."""
    revenue, units = F.col("_s").cast("double"), F.when(F.col("_nu") > 0, F.col("_u"))
    return _rolled(PRODUCTS, spark, orders).select(
        "product", F.col("_n").alias("total_orders"), units.alias("total_units_sold"),
        round_half_up(revenue, 2).alias("total_revenue"), round_half_up(revenue / F.col("_na"), 2).alias("avg_unit_price"),
        round_half_up(revenue / units, 2).alias("true_unit_price"))
