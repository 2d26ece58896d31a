"""Registered queries that write and read back: sinks, catalog, incremental
loads and streams.  Each call works in a fresh folder below the shared
checkpoint folder and returns the read-back result."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklake import schemas
from sparklake.plans import events as ev
from sparklake.plans import flights as fl
from sparklake.plans import gold_views as gv
from sparklake.plans import medallion as md
from sparklake.plans.registry import feed_of, items_of, register, silver_customers_of, silver_orders_of
from sparklake.session import scratch_path
from sparklake.sources import adapters as ad
from sparklake.sources import catalog as cat
from sparklake.sources import files as io
from sparklake.sources.tables import table
from sparklake.streaming import events as sev
from sparklake.streaming import incremental as inc
from sparklake.streaming import merge
from sparklake.streaming import steps


@register("csv_bronze_scan")
def csv_bronze_scan(spark, sf):
    path = scratch_path(spark, "bronze_csv")
    io.write_csv(ad.load_bronze_orders(spark, sf), path)
    return io.read_bronze(spark, path, "orders")


@register("csv_recursive_scan")
def csv_recursive_scan(spark, sf):
    root = scratch_path(spark, "bronze_nested")
    io.write_csv(ad.load_bronze_orders(spark, sf), f"{root}/orders/load")
    io.write_csv(ad.load_order_changes(spark, sf), f"{root}/cdc/orders/1996/01/02")
    return io.read_bronze(spark, root, "orders", recursive=True)


def broken_lines(bronze):
    """Bronze rows as CSV lines, some of which do not fit: values missing, one too many, a quote left open."""
    k = F.col("order_id").cast("bigint") % 53
    cells = [F.coalesce(c, F.lit("")) for c in bronze.columns]
    short, opened = cells[:7], [F.concat(F.lit('"'), c) if i == 2 else c for i, c in enumerate(cells)]
    line = (F.when(k == 4, F.concat_ws(",", *short)).when(k == 5, F.concat_ws(",", *cells, F.lit("extra")))
             .when(k == 6, F.concat_ws(",", *opened)).otherwise(F.concat_ws(",", *cells)))
    return bronze.select(line.alias("value"))


@register("csv_quarantine")
def csv_quarantine(spark, sf):
    """Lines that do not fit the schema, as they were, and (line NULL) the number of rows that do."""
    root = scratch_path(spark, "bronze_checked")
    broken_lines(ad.load_bronze_orders(spark, sf)).write.text(f"{root}/lines")
    io.split_bronze(spark, f"{root}/lines", f"{root}/split", header=False)
    good, quarantine = io.read_split(spark, f"{root}/split")
    bad = quarantine.groupBy("line").agg(F.count(F.lit(1)).alias("row_count"))
    return bad.unionAll(good.agg(F.count_if(F.col("order_id").isNotNull()).alias("row_count")).select(
        F.lit(None).cast("string").alias("line"), "row_count"))


@register("parquet_scan")
def parquet_scan(spark, sf):
    path = scratch_path(spark, "flights_by_month")
    f = ad.load_flights(spark, sf)
    f = f.withColumn("year", F.year("flight_date")).withColumn("month", F.month("flight_date"))
    io.write_parquet(f, path, partition_by=["year", "month"])
    return io.read_parquet(spark, path)


@register("parquet_roundtrip")
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "gold_daily_sales")
    io.write_parquet(md.daily_sales(silver_orders_of(spark, sf)), path)
    return io.read_parquet(spark, path)


@register("partitioned_sink_roundtrip")
def partitioned_sink_roundtrip(spark, sf):
    path = scratch_path(spark, "silver_orders")
    io.write_parquet(silver_orders_of(spark, sf), path, partition_by=["year", "month"])
    # a second, dynamic overwrite of the same rows replaces only their partitions
    io.write_parquet(silver_orders_of(spark, sf), path, partition_by=["year", "month"], dynamic=True)
    return io.read_parquet(spark, path)


def _changes_silver(spark, sf):
    return md.silver_orders(ad.load_order_changes(spark, sf), now=False)


@register("append_sink")
def append_sink(spark, sf):
    path = scratch_path(spark, "silver_append")
    io.write_parquet(silver_orders_of(spark, sf), path, mode="append")
    io.write_parquet(_changes_silver(spark, sf), path, mode="append")
    return io.read_parquet(spark, path)


DATE_PART_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("op", T.StringType()),
    T.StructField("amount", T.StringType()), T.StructField("updated_at", T.StringType()),
    T.StructField("commit_seq", T.IntegerType()),
    T.StructField("year", T.StringType()), T.StructField("month", T.StringType()),
    T.StructField("day", T.StringType())])


@register("cdc_date_partitioned_sink")
def cdc_date_partitioned_sink(spark, sf):
    path = scratch_path(spark, "cdc_by_day")
    feed = feed_of(spark, sf).select("order_id", "op", "amount", "updated_at", "commit_seq")
    parts = io.with_date_parts(feed.withColumn("_t", F.col("updated_at").try_cast("timestamp_ntz")), "_t")
    io.write_parquet(parts.drop("_t"), path, partition_by=["year", "month", "day"])
    return io.read_parquet(spark, path, schema=DATE_PART_SCHEMA)


@register("write_metrics")
def write_metrics(spark, sf):
    path = scratch_path(spark, "silver_metrics")
    m = io.write_with_metrics(silver_orders_of(spark, sf), path, partition_by=["year", "month"])
    return spark.createDataFrame([("silver_orders", int(m["rows_written"]))],
                                 "table_name string, rows_written bigint")


@register("insert_select")
def insert_select(spark, sf):
    path = scratch_path(spark, "mom_table")
    name = f"mom_{path.rsplit('/', 1)[-1][:12]}"
    spark.sql(f"""CREATE TABLE {name} (route STRING, month STRING, cancellations BIGINT, prev_cancellations BIGINT,
                  variation_pct DOUBLE, trend STRING) USING parquet LOCATION '{path}'""")
    fl.mom_change(ad.load_flights(spark, sf)).write.insertInto(name)
    spark.sql(f"DROP TABLE {name}")  # files stay: the table was external
    return spark.read.parquet(path)


@register("table_lifecycle")
def table_lifecycle(spark, sf):
    path = scratch_path(spark, "crew_table")
    name = f"crew_{path.rsplit('/', 1)[-1][:12]}"
    schema = "id BIGINT, route STRING, carrier BIGINT, c_name STRING, role STRING"
    spark.createDataFrame([], schema).write.option("path", path).saveAsTable(name)
    fl.crew_assignment(ad.load_flights(spark, sf),
                       table(spark, sf, "customer", ["c_name", "c_mktsegment"])).write.insertInto(name)
    spark.sql(f"DROP TABLE {name}")  # files stay: the table was external
    return spark.read.parquet(path)


# -- sorted sinks ------------------------------------------------------------------
def _sorted_back(spark, df, order, name):
    path = scratch_path(spark, name)
    io.write_sorted(df, path, order)
    return io.with_file_position(spark, path)


@register("sorted_daily_sales")
def sorted_daily_sales(spark, sf):
    """Gold written in date order; position is the row's place in the files read back."""
    return _sorted_back(spark, md.daily_sales(silver_orders_of(spark, sf)), ["date"], "sorted_sales")


@register("sorted_cancellations")
def sorted_cancellations(spark, sf):
    return _sorted_back(spark, *fl.sorted_cancellations(ad.load_flights(spark, sf)), "sorted_cancellations")


@register("sorted_mom_change")
def sorted_mom_change(spark, sf):
    return _sorted_back(spark, *fl.sorted_mom(ad.load_flights(spark, sf)), "sorted_mom")


# -- catalog -------------------------------------------------------------------------
@register("catalog_layers")
def catalog_layers(spark, sf):
    """The listing of the layers, each table with its rows as read through the catalog."""
    root = scratch_path(spark, "warehouse")
    prefix = "l" + root.rsplit("/", 1)[-1][:8] + "_"
    dbs = cat.create_layers(spark, root, prefix=prefix)
    io.write_csv(ad.load_bronze_orders(spark, sf), f"{root}/data/bronze/orders")
    io.write_parquet(silver_orders_of(spark, sf), f"{root}/data/silver/orders", partition_by=["year", "month"])
    silver = io.read_parquet(spark, f"{root}/data/silver/orders")  # gold reads the written silver
    io.write_parquet(md.daily_sales(silver), f"{root}/data/gold/daily_sales")
    cat.discover_table(spark, dbs[0], "orders", f"{root}/data/bronze/orders", "csv", {"header": "true"})
    cat.discover_table(spark, dbs[1], "orders", f"{root}/data/silver/orders")
    cat.discover_table(spark, dbs[2], "daily_sales", f"{root}/data/gold/daily_sales")
    listed = cat.list_tables(spark, dbs).collect()  # catalog entries, a few
    rows = [(r["database"].removeprefix(prefix), r["table_name"], r["table_type"],
             spark.table(f"{r['database']}.{r['table_name']}").count()) for r in listed]
    cat.drop_layers(spark, dbs)
    return spark.createDataFrame(rows, "database string, table_name string, table_type string, row_count bigint")


@register("catalog_discover")
def catalog_discover(spark, sf):
    """Two crawls: the second finds the column that later files have, in the same entry."""
    root = scratch_path(spark, "discover")
    prefix = "d" + root.rsplit("/", 1)[-1][:8] + "_"
    dbs = cat.create_layers(spark, root, layers=("silver",), prefix=prefix)
    path = f"{root}/data/silver/orders"
    io.write_parquet(silver_orders_of(spark, sf), path, partition_by=["year", "month"])
    cat.discover_table(spark, dbs[0], "orders", path)
    later = _changes_silver(spark, sf).withColumn("channel", F.lit("web"))
    io.write_parquet(later, path, mode="append", partition_by=["year", "month"])
    cat.discover_table(spark, dbs[0], "orders", path)
    result = scratch_path(spark, "rollup")
    # read through the catalog, then written, so that the entry can go
    io.write_parquet(spark.sql(f"""SELECT status, channel, COUNT(*) AS total,
        CAST(ROUND(SUM(CAST(amount AS DECIMAL(38,9))), 2) AS DOUBLE) AS revenue
        FROM {dbs[0]}.orders GROUP BY status, channel"""), result)
    cat.drop_layers(spark, dbs)
    return io.read_parquet(spark, result)


@register("catalog_crawl")
def catalog_crawl(spark, sf):
    """``catalog_discover`` by crawls with a log: the second looks only into the files that came after the first."""
    root = scratch_path(spark, "crawl")
    dbs = cat.create_layers(spark, root, layers=("silver",), prefix="c" + root.rsplit("/", 1)[-1][:8] + "_")
    path = f"{root}/data/silver/orders"
    io.write_parquet(silver_orders_of(spark, sf), path, partition_by=["year", "month"])
    cat.crawl(spark, dbs[0], "orders", path, f"{root}/log")
    later = _changes_silver(spark, sf).withColumn("channel", F.lit("web"))
    io.write_parquet(later, path, mode="append", partition_by=["year", "month"])
    cat.crawl(spark, dbs[0], "orders", path, f"{root}/log")
    result = scratch_path(spark, "crawl_rollup")
    io.write_parquet(spark.sql(f"""SELECT status, channel, COUNT(*) AS total,
        CAST(ROUND(SUM(CAST(amount AS DECIMAL(38,9))), 2) AS DOUBLE) AS revenue
        FROM {dbs[0]}.orders GROUP BY status, channel"""), result)
    cat.drop_layers(spark, dbs)
    return io.read_parquet(spark, result)


@register("schema_evolution_diff")
def schema_evolution_diff(spark, sf):
    """Schema changes of a second file and, read through the changed table, how many rows
    have a value in each changed column."""
    root = scratch_path(spark, "evolve")
    prefix = "e" + root.rsplit("/", 1)[-1][:8] + "_"
    db = cat.create_layers(spark, root, layers=("silver",), prefix=prefix)[0]
    path = f"{root}/data/customers"
    v1 = silver_customers_of(spark, sf)
    io.write_parquet(v1, path)
    cat.discover_table(spark, db, "customers", path)
    v2 = (v1.filter(F.col("customer_id") % 3 == 0).drop("email").withColumn("segment", F.lit("retail"))
            .withColumn("customer_id", F.col("customer_id").cast("bigint")))
    diff = cat.evolve_table(spark, f"{db}.customers", v2.schema)
    io.write_parquet(v2, path, mode="append")
    spark.catalog.refreshTable(f"{db}.customers")
    t = spark.table(f"{db}.customers")
    filled = t.agg(*[F.count(c).alias(c) for c in t.columns]).first().asDict()  # one row
    rows = [(*r, filled[r["column"]]) for r in diff.collect()]  # a row a changed column
    cat.drop_layers(spark, [db])
    return spark.createDataFrame(rows, "column string, change string, old_type string, new_type string, "
                                       "action string, filled_rows bigint")


# -- incremental bookmark ----------------------------------------------------
def _silver_batch(batch):
    return md.silver_orders(batch, now=False)


def _bookmark_runs(spark, files, transform, table="orders"):
    """One run after each file has landed and one more; the sink and the rows of each run."""
    root = scratch_path(spark, "incremental")
    src, sink, ckpt = f"{root}/bronze", f"{root}/silver", f"{root}/_bookmark"
    runs = []
    for i, df in enumerate([*files, None]):
        if df is not None:
            io.write_csv(df, f"{root}/staging/batch{i}")
            _move_csv_files(spark, f"{root}/staging/batch{i}", src, f"batch{i}")
        runs.append(inc.run_incremental(spark, src, sink, ckpt, transform=transform, table=table))
    return sink, runs


def _order_files(spark, sf):
    return [ad.load_bronze_orders(spark, sf), ad.load_order_changes(spark, sf), ad.load_order_reinserts(spark, sf)]


def _move_csv_files(spark, staging, dest, tag, fs=None):
    """Publish a batch's CSV part files into the watched folder under new names
    (a rename is atomic, so the stream never sees a half-written file)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(staging)
    fs = fs or path.getFileSystem(conf)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(dest))
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if name.endswith(".csv"):
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(f"{dest}/{tag}-{name}"))
    return fs


def _with_date_columns(df):
    return df.drop("year", "month").withColumns({"year": F.year("created_at"), "month": F.month("created_at")})


@register("incremental_bookmark")
def incremental_bookmark(spark, sf):
    sink, _ = _bookmark_runs(spark, _order_files(spark, sf)[:2], _silver_batch)
    return _with_date_columns(inc.read_silver(spark, sink, mode="append"))


@register("incremental_empty_run")
def incremental_empty_run(spark, sf):
    _, runs = _bookmark_runs(spark, _order_files(spark, sf)[:2], _silver_batch)
    return spark.createDataFrame([(i + 1, int(n)) for i, n in enumerate(runs)],
                                 "run bigint, rows_written bigint")


@register("incremental_merge")
def incremental_merge(spark, sf):
    """Merged silver after three files: updates, deletes and orders that come back."""
    sink, _ = _bookmark_runs(spark, _order_files(spark, sf), md.silver_changes)
    return _with_date_columns(inc.read_silver(spark, sink, mode="merge"))


@register("incremental_customers")
def incremental_customers(spark, sf):
    first = ad.load_bronze_customers(spark, sf)
    sink, _ = _bookmark_runs(spark, [first, ad.customer_changes(first)], md.customer_changes, table="customers")
    return inc.read_silver(spark, sink, mode="merge", key="customer_id")


# -- streams ---------------------------------------------------------------------
def _land_records(spark, sf, root, files: int = 4):
    """Publish the encoded stream records as a few Parquet files (arrival order by seq)."""
    recs = ad.load_stream_records(spark, sf)
    recs.repartitionByRange(files, "seq").write.parquet(f"{root}/records")
    return f"{root}/records"


@register("stream_ingest")
def stream_ingest(spark, sf):
    root = scratch_path(spark, "stream")
    src = _land_records(spark, sf, root)
    sev.ingest(spark, src, f"{root}/out", f"{root}/_ckpt", max_files_per_trigger=1)
    return sev.item_view(spark, f"{root}/out")


@register("stream_batch_counters")
def stream_batch_counters(spark, sf):
    """Processed and failed records of each batch, observed while the batch is written; three landings, three batches."""
    root = scratch_path(spark, "stream_counters")
    recs = ad.load_stream_records(spark, sf)
    for i in range(3):
        recs.where(F.col("seq") % 3 == i).write.parquet(f"{root}/records/{i}")
        sev.ingest(spark, f"{root}/records/*", f"{root}/out", f"{root}/_ckpt")
    letters = sev.dead_letters(spark, f"{root}/out").groupBy("batch_id").agg(F.count(F.lit(1)).alias("dead_letters"))
    return sev.batch_counters(spark, f"{root}/out").join(letters, "batch_id", "left")


#: The second landing of ``stream_step_waits`` begins here.
SECOND_LANDING = "2024-01-16"


@register("stream_step_waits")
def stream_step_waits(spark, sf):
    """Placed orders with their confirmation within five minutes, matched by a stateful stream in two landings; the
    second brings some records of the first again, and confirms orders that the first has placed."""
    root = scratch_path(spark, "stream_steps")
    events = ad.load_order_events(spark, sf)
    again = events.where("event_id % 10 < 3")
    first = events.where(F.col("timestamp") < SECOND_LANDING)
    second = events.where(F.col("timestamp") >= SECOND_LANDING).unionAll(again)
    for i, landed in enumerate([first, second]):
        ad.stream_records(landed).write.parquet(f"{root}/records/{i}")
        steps.follow(spark, f"{root}/records/*", f"{root}/waits", f"{root}/_ckpt", step="order_placed",
                     following="order_confirmed", limit="5 minutes")
    return steps.followed(spark, f"{root}/waits")


@register("raw_hourly_landing")
def raw_hourly_landing(spark, sf):
    root = scratch_path(spark, "landing")
    src = _land_records(spark, sf, root)
    sev.land_hourly(spark, src, f"{root}/raw", f"{root}/_ckpt")
    return spark.read.schema(sev.LANDING_SCHEMA).parquet(f"{root}/raw").drop("seq")


@register("stream_silver")
def stream_silver(spark, sf):
    """Two landings and two refreshes: the second brings rows that are hours late, some with
    a zone offset in their time, and changed repeats of rows that silver has."""
    root = scratch_path(spark, "stream_silver")
    for i, part in enumerate(ad.late_arrivals(ad.load_order_events(spark, sf))):
        ad.stream_records(part).write.parquet(f"{root}/records/{i}")
        sev.land_hourly(spark, f"{root}/records/*", f"{root}/raw", f"{root}/_ckpt_raw")
        sev.refresh_silver(spark, f"{root}/raw", f"{root}/silver", f"{root}/_ckpt_silver")
    return spark.read.schema(sev.LANDING_SCHEMA).parquet(f"{root}/silver").drop("seq")


def _gold_refreshes(spark, sf, build, silver_part, gold_part, by_month=False):
    """Gold after three change files: built from merged silver, then the touched parts again.
    A changed order touches the part where it is now and the part where it was, both of which the merge has logged.
    ``by_month``: parts of gold are silver's own, so only these are read."""
    root = scratch_path(spark, "gold_refresh")
    orders = gv.merged_orders(f"{root}/silver", buckets=8)
    for i, file in enumerate(_order_files(spark, sf)):
        merge.merge_batch(orders, md.silver_changes(file), i)
        changes, silver = orders.changes(spark, i), orders.rows(spark)
        if by_month:
            silver = silver.where(F.col(merge.PART).isin([r[0] for r in changes.select(merge.PART).distinct().collect()]))
        sev.refresh_gold(silver.drop(merge.PART), changes.select(silver_part.alias("part")), f"{root}/gold", build,
                         silver_part, gold_part)
    return sev.read_gold(spark, f"{root}/gold")


@register("gold_refresh")
def gold_refresh(spark, sf):
    return _gold_refreshes(spark, sf, md.daily_sales, sev.month_of("created_at"), sev.month_of("date"), by_month=True)


@register("gold_refresh_customer")
def gold_refresh_customer(spark, sf):
    customers = silver_customers_of(spark, sf)
    bucket = sev.key_bucket("customer_id")
    return _gold_refreshes(spark, sf, lambda s: md.customer_summary(s, customers), bucket, bucket)


@register("gold_refresh_product")
def gold_refresh_product(spark, sf):
    """Totals are stored by product; the rank, which any product can move, is taken on reading."""
    bucket = sev.key_bucket("product")
    return md.with_revenue_rank(_gold_refreshes(spark, sf, md.product_totals, bucket, bucket))


def _merged_runs(spark, sf, *views):
    """Orders merged and views brought up to date by a bookmarked run after each of three files has landed."""
    root = scratch_path(spark, "merged")
    orders, src = gv.merged_orders(f"{root}/orders", buckets=8), f"{root}/bronze"
    for i, file in enumerate(_order_files(spark, sf)):
        io.write_csv(file, f"{root}/staging/{i}")
        _move_csv_files(spark, f"{root}/staging/{i}", src, f"batch{i}")
        bronze = spark.readStream.schema(schemas.BRONZE["orders"]).options(**io.CSV_READ).csv(src)
        merge.run_merge(spark, bronze, orders, f"{root}/_bookmark", md.silver_changes, views)
    return orders


@register("incremental_merge_pruned")
def incremental_merge_pruned(spark, sf):
    """Merged silver after three files; each run reads and rewrites only the months that hold its orders, found by key."""
    return _merged_runs(spark, sf).rows(spark).drop(merge.PART)


@register("gold_delta")
def gold_delta(spark, sf):
    """Daily sales kept up by what each file changed."""
    return gv.daily_sales(spark, _merged_runs(spark, sf, gv.DAYS))


@register("gold_delta_customer")
def gold_delta_customer(spark, sf):
    customers = silver_customers_of(spark, sf)
    return gv.customer_summary(spark, _merged_runs(spark, sf, gv.CUSTOMERS), customers)


@register("gold_delta_product")
def gold_delta_product(spark, sf):
    totals = scratch_path(spark, "product_totals")  # a row a product; the rank reads them several times
    io.write_parquet(gv.product_totals(spark, _merged_runs(spark, sf, gv.PRODUCTS)), totals)
    return md.with_revenue_rank(io.read_parquet(spark, totals))


@register("stream_ingest_latest")
def stream_ingest_latest(spark, sf):
    """Consumer that starts at the newest record: the files present at its first start are
    skipped, every record landing afterwards is processed.  The two landings are two
    shards, whose sequence numbers overlap."""
    root = scratch_path(spark, "stream_latest")
    recs = ad.load_stream_records(spark, sf)
    src = f"{root}/records/*"
    recs.filter(F.col("seq") % 2 == 0).write.parquet(f"{root}/records/a")
    sev.ingest(spark, src, f"{root}/out", f"{root}/_ckpt", start="latest")
    recs.filter(F.col("seq") % 2 == 1).write.parquet(f"{root}/records/b")
    sev.ingest(spark, src, f"{root}/out", f"{root}/_ckpt", start="latest")
    return sev.item_view(spark, f"{root}/out")


# -- stored access paths of the item table -----------------------------------------------
ITEM_ORDER = ["pk", "sk", "gsi1pk", "gsi1sk", "event_id", "order_id", "customer_id", "event_type", "product", "amount",
              "status", "timestamp"]


def _stored_items(spark, sf, key, sort):
    path = scratch_path(spark, f"items_by_{key}")
    ev.store(items_of(spark, sf), path, key, sort)
    return path


@register("order_history")
def order_history(spark, sf):
    """Every order's events as the table stored by pk has them, with their place in the order."""
    rows = ev.stored(spark, _stored_items(spark, sf, "pk", ["sk"]), "pk")
    return rows.select("pk", "sk", "event_type", "status", "timestamp", "position")


@register("order_history_of")
def order_history_of(spark, sf):
    """One order by point lookup: one bucket folder is read."""
    found = ev.history_of(spark, _stored_items(spark, sf, "pk", ["sk"]), "o7")
    w = Window.orderBy("sk")
    return found.select(*ITEM_ORDER, F.row_number().over(w).cast("bigint").alias("position"))


@register("customer_orders")
def customer_orders(spark, sf):
    """The index copy: all attributes, by customer and time, with the place in the customer."""
    rows = ev.stored(spark, _stored_items(spark, sf, "gsi1pk", ["gsi1sk", "pk", "sk"]), "gsi1pk")
    return rows.select(*ITEM_ORDER, "position")
