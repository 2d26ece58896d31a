"""Merged tables and their views against plain Python and a full rebuild."""

import datetime as dt
import random

from pyspark.sql import functions as F

from sparklake.plans import gold_views as gv
from sparklake.plans import medallion as md
from sparklake.session import scratch_path
from sparklake.streaming import merge

VIEWS = (gv.DAYS, gv.PRODUCTS, gv.CUSTOMERS)
FIELDS = gv.ORDER_FIELDS.fieldNames()


def _order(key, customer, product, quantity, amount, at, op="U"):
    return (key, customer, product, quantity, amount, "NEW", at, at, at and at.year, at and at.month, op)


def _batch(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in gv.ORDER_FIELDS) + ", op string")


def _apply(spark, orders, rows, n):
    merge.merge_batch(orders, _batch(spark, rows), n)
    for view in VIEWS:
        merge.refresh_view(view, orders, spark, n)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _holds(spark, orders, model):
    """The table is the model; gold from the views is gold rebuilt from the table."""
    rows = orders.rows(spark)
    assert _rows(rows.select(*FIELDS)) == sorted((r[:-1] for r in model.values()), key=repr)
    assert rows.where("part <> coalesce(date_format(created_at, 'yyyy-MM'), 'none')").isEmpty()
    assert _rows(orders.places(spark).select("order_id", "part")) == _rows(rows.select("order_id", "part"))
    rebuilt = _batch(spark, list(model.values())).drop("op")
    customers = spark.createDataFrame([(i, f"c{i}", "e", "x") for i in range(4)], "customer_id int, name string, email string, country string")
    pairs = [(gv.daily_sales(spark, orders), md.daily_sales(rebuilt)), (gv.product_totals(spark, orders), md.product_totals(rebuilt)),
             (gv.customer_summary(spark, orders, customers), md.customer_summary(rebuilt, customers))]
    for kept, full in pairs:
        assert kept.columns == full.columns
        assert _rows(kept) == _rows(full)


def test_views_equal_a_full_rebuild_over_random_batches(spark):
    rng, model = random.Random(5), {}
    orders = gv.merged_orders(scratch_path(spark, "t_views"), buckets=3)
    keys = [f"o{i}" for i in range(25)] + [None]
    for n in range(4):
        batch = []
        for key in rng.sample(keys, len(keys) if n == 0 else 9):
            at = rng.choice([None] + [dt.datetime(2024, m, d, rng.randrange(24)) for m in (1, 2, 3) for d in (1, 2)])
            batch.append(_order(key, rng.choice([None, 1, 2, 3]), rng.choice([None, "p", "q"]), rng.choice([None, 1, 2]),
                                rng.choice([None, 0.105, 2.5, 7.25]), at, rng.choice("UUUD") if n else "I"))
        _apply(spark, orders, batch, n)
        for row in batch:
            if row[-1] == "D":
                model.pop(row[0], None)
            else:
                model[row[0]] = row
        _holds(spark, orders, model)


def test_the_greatest_value_goes_comes_back_and_parts_empty(spark):
    orders = gv.merged_orders(scratch_path(spark, "t_high"))
    day = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    feb = dt.datetime(2024, 2, 9)
    steps = [[_order("a", 1, "p", 1, 1.0, day[2]), _order("b", 1, "p", 1, 2.0, day[0]), _order("c", 2, "q", 1, 3.0, feb)],
             [_order("a", 1, "p", 1, 1.0, day[2], "D"), _order("c", 2, "q", 1, 3.0, day[1])],  # the last day goes, February empties
             [_order("b", 1, "p", 1, 2.0, day[0], "D"), _order("none", 1, "p", 1, 2.0, day[0], "D")],  # no row of the key is left
             [_order("b", 1, "p", 1, 2.0, day[0])], []]
    model = {}
    for n, rows in enumerate(steps):
        _apply(spark, orders, rows, n)
        for row in rows:
            model.pop(row[0], None)
            if row[-1] != "D":
                model[row[0]] = row
        _holds(spark, orders, model)
    assert {r[0] for r in orders.rows(spark).select("part").distinct().collect()} == {"2024-01"}


def test_a_batch_that_is_run_again_changes_nothing(spark):
    orders = gv.merged_orders(scratch_path(spark, "t_again"))
    jan, feb = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    first = [_order("a", 1, "p", 1, 1.0, jan), _order("b", 1, "p", 1, 2.0, jan)]
    second = [_order("a", 1, "p", 1, 5.0, feb), _order("b", 1, "p", 1, 2.0, jan, "D")]
    model = {"a": second[0]}
    _apply(spark, orders, first, 0)
    # ended when the rows were written, but not the places, and one view of three
    changes = f"{orders.root}/changes/batch_id=1"
    merge._log_changes(orders, _batch(spark, second), 1)
    logged = _rows(spark.read.parquet(changes))
    merge._replace(orders.rows(spark), orders.changes(spark, 1), f"{orders.root}/rows", "part", "order_id")
    merge.refresh_view(gv.DAYS, orders, spark, 1)
    for _ in range(2):
        _apply(spark, orders, second, 1)
        assert _rows(spark.read.parquet(changes)) == logged
        _holds(spark, orders, model)


def test_only_touched_parts_are_read_and_written(spark):
    orders = gv.merged_orders(scratch_path(spark, "t_parts"))
    months = [dt.datetime(2024, m, 1) for m in (1, 2, 3, 4)]
    _apply(spark, orders, [_order(f"o{i}", i, "p", 1, 1.0, at) for i, at in enumerate(months)], 0)

    def files(folder):
        found = spark.read.parquet(f"{orders.root}/{folder}").select("part", F.col("_metadata.file_path").alias("f")).distinct()
        return {r["part"]: r["f"] for r in found.collect()}

    folders = ["rows", *[f"views/{v.name}" for v in VIEWS]]
    before = {f: files(f) for f in folders}
    _apply(spark, orders, [_order("o1", 1, "p", 2, 4.0, months[2])], 1)
    for f in folders:
        after = files(f)
        assert {p for p in before[f] if after.get(p) == before[f][p]} == {"2024-01", "2024-04"}
    plan = orders.rows(spark).where(F.col("part").isin(merge._values(orders.changes(spark, 1), "part")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in text and "2024-02" in text and "2024-03" in text and "2024-01" not in text


def test_a_batch_is_written_once_to_the_log(spark):
    orders = gv.merged_orders(scratch_path(spark, "t_once"), buckets=2)
    at = dt.datetime(2024, 1, 1)
    merge.merge_batch(orders, _batch(spark, [_order(f"o{i}", i, "p", 1, 1.0, at) for i in range(10)]), 0)
    below = spark.read.schema("order_id string").option("recursiveFileLookup", "true").parquet(orders.root)
    assert below.count() == 30  # log, rows and places
    merge.merge_batch(orders, _batch(spark, [_order("o1", 1, "p", 1, 1.0, at, "D"), _order("x", 1, "p", 1, 1.0, at, "D")]), 1)
    logged = orders.changes(spark, 1).select("order_id", "_sign").collect()
    assert [tuple(r) for r in logged] == [("o1", -1)]  # a delete is no row that came


def test_a_batch_from_which_nothing_goes_writes_its_view_once(spark):
    orders = gv.merged_orders(scratch_path(spark, "t_gains"))
    days = [dt.datetime(2024, 1, d) for d in (1, 2)]
    for n, at in enumerate(days):
        _apply(spark, orders, [_order(f"o{n}", 1, "p", 1, 1.0, at)], n)
    staged = f"{orders.root}/staged_{gv.CUSTOMERS.name}"
    assert not merge.path_exists(spark, staged)
    _apply(spark, orders, [_order("o1", 1, "p", 1, 1.0, days[1], "D")], 2)
    assert merge.path_exists(spark, staged)
    assert [r["_last"] for r in gv.CUSTOMERS.read(spark, orders).collect()] == [days[0]]
