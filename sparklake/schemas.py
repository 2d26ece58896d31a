"""Fixed schemas of the pipeline layers."""

from pyspark.sql import types as T

BRONZE_ORDER_COLUMNS = ("order_id", "customer_id", "product", "quantity", "amount", "status",
                        "created_at", "updated_at", "op")
BRONZE_CUSTOMER_COLUMNS = ("customer_id", "name", "email", "country", "created_at", "op")

# Bronze is text first, cast later: every column is a string, no inference.
BRONZE_ORDERS = T.StructType([T.StructField(c, T.StringType()) for c in BRONZE_ORDER_COLUMNS])
BRONZE_CUSTOMERS = T.StructType([T.StructField(c, T.StringType()) for c in BRONZE_CUSTOMER_COLUMNS])
BRONZE = {"orders": BRONZE_ORDERS, "customers": BRONZE_CUSTOMERS}

STREAM_RECORD = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("partition_key", T.StringType()),
    T.StructField("data", T.StringType()),
])
