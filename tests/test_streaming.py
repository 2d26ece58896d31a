"""Streaming and incremental jobs: restarts, replays, empty runs."""

import base64
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklake import schemas
from sparklake.plans import medallion as md
from sparklake.session import scratch_path
from sparklake.sources import adapters as ad
from sparklake.sources import files as io
from sparklake.streaming import events as sev
from sparklake.streaming import incremental as inc
from sparklake.streaming import steps

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _records(spark):
    return ad.load_stream_records(spark, SF)


def test_ingest_restart_and_new_file(spark):
    root = scratch_path(spark, "t_stream")
    recs = _records(spark)
    cut = recs.agg(F.percentile_approx("seq", 0.5)).first()[0]
    recs.filter(F.col("seq") <= cut).write.parquet(f"{root}/src/a")
    src = f"{root}/src/*"
    sev.ingest(spark, src, f"{root}/out", f"{root}/ck", max_files_per_trigger=1)
    first = sev.item_view(spark, f"{root}/out").count()
    sev.ingest(spark, src, f"{root}/out", f"{root}/ck")  # restart, nothing new
    assert sev.item_view(spark, f"{root}/out").count() == first
    recs.filter(F.col("seq") > cut).write.parquet(f"{root}/src/b")
    sev.ingest(spark, src, f"{root}/out", f"{root}/ck")
    everything = ev_items(spark).count()
    assert sev.item_view(spark, f"{root}/out").count() == everything > first


def ev_items(spark):
    from sparklake.plans import events as ev
    return ev.to_items(ev.good(ev.decode(_records(spark))))


def test_ingest_start_latest_skips_existing(spark):
    root = scratch_path(spark, "t_latest")
    recs = _records(spark)
    cut = recs.agg(F.max("seq")).first()[0] - 50
    recs.filter(F.col("seq") <= cut).write.parquet(f"{root}/src/a")
    src = f"{root}/src/*"
    sev.ingest(spark, src, f"{root}/out", f"{root}/ck", start="latest")
    recs.filter(F.col("seq") > cut).write.parquet(f"{root}/src/b")
    sev.ingest(spark, src, f"{root}/out", f"{root}/ck", start="latest")
    seqs = [r["seq"] for r in spark.read.parquet(f"{root}/out/batches/kind=items").select("seq").collect()]
    assert seqs and min(seqs) > cut


def test_incremental_runs_then_empty(spark):
    root = scratch_path(spark, "t_incr")
    src, sink, ck = f"{root}/bronze", f"{root}/silver", f"{root}/ck"
    io.write_csv(ad.load_bronze_orders(spark, SF), f"{src}/batch1")
    runs = [inc.run_incremental(spark, f"{src}/*", sink, ck, transform=lambda b: md.silver_orders(b, now=False))]
    io.write_csv(ad.load_order_changes(spark, SF), f"{src}/batch2")
    runs.append(inc.run_incremental(spark, f"{src}/*", sink, ck, transform=lambda b: md.silver_orders(b, now=False)))
    runs.append(inc.run_incremental(spark, f"{src}/*", sink, ck, transform=lambda b: md.silver_orders(b, now=False)))
    expected1 = md.silver_orders(ad.load_bronze_orders(spark, SF), now=False).count()
    expected2 = md.silver_orders(ad.load_order_changes(spark, SF), now=False).count()
    assert runs == [expected1, expected2, 0]
    appended = inc.read_silver(spark, sink, mode="append").count()
    merged = inc.read_silver(spark, sink, mode="merge").count()
    assert appended == expected1 + expected2 and merged <= appended


def test_view_over_batches_is_the_whole(spark):
    root = scratch_path(spark, "t_batches")
    recs = _records(spark)
    cut = recs.agg(F.percentile_approx("seq", 0.5)).first()[0]
    src = f"{root}/src/*"
    for name, part in (("a", recs.filter(F.col("seq") <= cut)), ("b", recs.filter(F.col("seq") > cut))):
        part.write.parquet(f"{root}/src/{name}")
        sev.ingest(spark, src, f"{root}/out", f"{root}/ck")
    after = sev.item_view(spark, f"{root}/out")
    whole = sorted(ev_items(spark).collect(), key=str)
    assert sorted(after.collect(), key=str) == whole


def _record(spark, rows):
    """Records (seq, data) of events (order, id, type, amount, time)."""
    df = spark.createDataFrame(rows, "seq bigint, order_id string, event_id string, event_type string, amount string, timestamp string")
    body = F.to_json(F.struct("order_id", "event_id", "event_type", "amount", "timestamp",
                              F.lit("7").alias("customer_id"), F.lit("s").alias("status")))
    return df.select("seq", F.col("order_id").alias("partition_key"), F.base64(F.encode(body, "UTF-8")).alias("data"))


def test_latest_start_takes_later_files_with_lower_sequence_numbers(spark):
    root = scratch_path(spark, "t_shards")
    _record(spark, [(10, "o1", "uuid-a", "t", "1", "2024-01-01T00:00:00Z")]).write.parquet(f"{root}/src/a")
    sev.ingest(spark, f"{root}/src/*", f"{root}/out", f"{root}/ck", start="latest")
    _record(spark, [(5, "o2", "uuid-b", "t", "2", "2024-01-01T00:00:00Z")]).write.parquet(f"{root}/src/b")
    sev.ingest(spark, f"{root}/src/*", f"{root}/out", f"{root}/ck", start="latest")
    assert [r["event_id"] for r in sev.item_view(spark, f"{root}/out").collect()] == ["uuid-b"]


def test_view_of_a_stream_without_records(spark):
    root = scratch_path(spark, "t_none")
    view = sev.item_view(spark, f"{root}/out")
    assert view.count() == 0 and view.columns == list(sev.ITEM_COLUMNS)


def test_silver_takes_late_rows_and_the_newest_repeat(spark):
    root = scratch_path(spark, "t_late")

    def run(i, rows):
        _record(spark, rows).write.parquet(f"{root}/src/{i}")
        sev.land_hourly(spark, f"{root}/src/*", f"{root}/raw", f"{root}/ck_raw")
        sev.refresh_silver(spark, f"{root}/raw", f"{root}/silver", f"{root}/ck")
        rows = spark.read.schema(sev.LANDING_SCHEMA).parquet(f"{root}/silver").collect()
        return sorted((r["order_id"], r["amount"], r["day"], r["hour"]) for r in rows)

    assert run(1, [(1, "a", "u1", "t", "1", "2024-01-01T23:30:00Z")]) == [("a", "1", "01", "23")]
    got = run(2, [(2, "b", "u2", "t", "2", "2024-01-01T20:00:00Z"), (3, "a", "u1", "t", "9", "2024-01-01T23:30:00Z"),
                  (4, "c", "u3", "t", "3", "2024-01-02T01:00:00+02:00"), (5, "d", "u4", "t", "4", "no time")])
    assert got == [("a", "9", "01", "23"), ("b", "2", "01", "20"), ("c", "3", "01", "23"), ("d", "4", "unknown", "unknown")]
    # an older record that arrives later changes nothing
    assert run(3, [(0, "a", "u1", "t", "0", "2024-01-01T23:30:00Z")]) == got


def test_gold_refresh_keeps_rows_without_a_date_and_drops_emptied_parts(spark):
    root = scratch_path(spark, "t_gold")

    def silver(rows):
        return spark.createDataFrame(rows, "order_id string, customer_id int, amount double, created_at timestamp_ntz")

    jan, feb = (dt.datetime(2024, m, 3) for m in (1, 2))
    part, of_date = sev.month_of("created_at"), sev.month_of("date")

    def gold(rows, touched):
        sev.refresh_gold(silver(rows), silver(touched).select(part.alias("p")), f"{root}/gold", md.daily_sales, part, of_date)
        return sorted(((str(r["date"]), r["total_orders"], r["total_revenue"]) for r in sev.read_gold(spark, f"{root}/gold").collect()))

    first = [("1", 1, 5.0, jan), ("2", 1, 7.0, None), ("3", 2, 1.0, feb)]
    assert gold(first, first) == [("2024-01-03", 1, 5.0), ("2024-02-03", 1, 1.0), ("None", 1, 7.0)]
    assert gold([("1", 1, 6.0, jan), ("2", 1, 7.0, None)], [("1", 1, 6.0, jan), ("3", 2, 1.0, feb)]) == [
        ("2024-01-03", 1, 6.0), ("None", 1, 7.0)]


def test_merge_uses_the_later_batch_and_applies_deletes(spark):
    root = scratch_path(spark, "t_merge")
    t = dt.datetime(2024, 1, 1)
    for i, rows in enumerate([[("a", 900.0, t, "U"), ("b", 1.0, t, "I"), ("c", 1.0, t, "I")],
                              [("a", 100.0, t, "U"), ("b", 1.0, None, "D")], [("b", 2.0, t, "I")]]):
        spark.createDataFrame(rows, "order_id string, amount double, updated_at timestamp_ntz, op string") \
            .write.parquet(f"{root}/batch_id={i}")
    got = {r["order_id"]: r["amount"] for r in inc.read_silver(spark, root, mode="merge").collect()}
    assert got == {"a": 100.0, "b": 2.0, "c": 1.0}


def test_customers_load_with_the_defaults(spark):
    root = scratch_path(spark, "t_customers")
    io.write_csv(ad.load_bronze_customers(spark, SF), f"{root}/bronze/1")
    n = inc.run_incremental(spark, f"{root}/bronze/*", f"{root}/silver", f"{root}/ck", transform=md.customer_changes,
                            table="customers")
    assert n == ad.load_bronze_customers(spark, SF).count()


def test_silver_refresh_reads_only_the_touched_hours(spark):
    root = scratch_path(spark, "t_hours")

    def run(i, rows):
        _record(spark, rows).write.parquet(f"{root}/src/{i}")
        sev.land_hourly(spark, f"{root}/src/*", f"{root}/raw", f"{root}/ck_raw")
        sev.refresh_silver(spark, f"{root}/raw", f"{root}/silver", f"{root}/ck")

    run(1, [(h, f"o{h}", f"u{h}", "t", "1", f"2024-01-01T{h:02d}:10:00Z") for h in range(24)])

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(f"{root}/silver") for f in fs if f.endswith(".parquet")}

    before = files()
    run(2, [(99, "late", "u99", "t", "1", "2024-01-01T05:50:00Z")])
    after = files()
    assert len(set(before) - after) == 1  # the one hour is rewritten
    rows = spark.read.schema(sev.LANDING_SCHEMA).parquet(f"{root}/silver")
    assert rows.count() == 25 and rows.where("hour = '05'").count() == 2
    pruned = rows.where(F.concat_ws("/", *sev.HOUR_PARTS).isin(["2024/01/01/05"]))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "2024/01/01/05" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]


def test_gold_part_with_an_escaped_name_goes_when_it_is_empty(spark):
    root = scratch_path(spark, "t_escaped")

    def gold(rows, touched):
        silver = spark.createDataFrame(rows, "name string, n int")
        sev.refresh_gold(silver, spark.createDataFrame([(t,) for t in touched], "p string"), f"{root}/gold",
                         lambda s: s.groupBy("name").agg(F.sum("n").alias("n")), F.col("name"), F.col("name"))
        return sorted((r["name"], r["n"]) for r in sev.read_gold(spark, f"{root}/gold").collect())

    assert gold([("a:b", 1), ("c/d=%", 2), ("e", 3)], ["a:b", "c/d=%", "e"]) == [("a:b", 1), ("c/d=%", 2), ("e", 3)]
    assert gold([("e", 3)], ["a:b", "c/d=%"]) == [("e", 3)]


def test_gold_refresh_picks_the_touched_parts_without_a_join(spark):
    root, plans = scratch_path(spark, "t_scope"), []

    def build(scope):
        plans.append(scope._jdf.queryExecution().executedPlan().toString())
        return scope.groupBy("name").agg(F.sum("n").alias("n"))

    def gold(rows, touched):
        silver = spark.createDataFrame(rows, "name string, n int")
        sev.refresh_gold(silver, spark.createDataFrame([(t,) for t in touched], "p string"), f"{root}/gold", build,
                         F.col("name"), F.col("name"))
        return sorted(((r["name"], r["n"]) for r in sev.read_gold(spark, f"{root}/gold").collect()), key=repr)

    assert gold([("a", 1), (None, 2), ("b", 3)], ["a", None, "b"]) == [("a", 1), ("b", 3), (None, 2)]
    assert gold([("a", 5), (None, 6)], [None]) == [("a", 1), ("b", 3), (None, 6)]
    assert gold([("a", 5), (None, 7)], ["a", "b"]) == [("a", 5), (None, 6)]
    assert gold([("a", 9)], [None, None]) == [("a", 5)]
    assert not any("Join" in plan or "Exchange" in plan for plan in plans)


@pytest.fixture
def uncoalesced(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _one_file(spark, root):
    _record(spark, [(i, f"o{i}", f"u{i % 9}", "t", "1", f"2024-01-01T{i % 24:02d}:10:00Z") for i in range(240)]) \
        .coalesce(1).write.parquet(f"{root}/src")
    return f"{root}/src"


def _tasks_by_folder(path):
    """Written files below ``path``: folder to the numbers of the tasks that wrote there."""
    found = {}
    for folder, _, files in os.walk(path):
        tasks = [f.split("-")[1] for f in files if f.endswith(".parquet")]
        if tasks:
            found[folder] = tasks
    return found


def test_landing_of_one_file_is_sorted_by_several_tasks(spark, uncoalesced):
    root = scratch_path(spark, "t_dealt").removeprefix("file:")
    sev.land_hourly(spark, _one_file(spark, root), f"{root}/raw", f"{root}/ck")
    tasks = _tasks_by_folder(f"{root}/raw")
    assert len(tasks) == 24 and all(len(t) == 1 for t in tasks.values())
    assert len({t for (t,) in tasks.values()}) > 1
    assert spark.read.schema(sev.LANDING_SCHEMA).parquet(f"{root}/raw").count() == 240


def test_ingest_of_one_file_is_decoded_by_several_tasks(spark, uncoalesced):
    root = scratch_path(spark, "t_spread").removeprefix("file:")
    sev.ingest(spark, _one_file(spark, root), f"{root}/out", f"{root}/ck")
    (tasks,) = _tasks_by_folder(f"{root}/out/batches").values()
    assert len(tasks) > 1
    assert sev.item_view(spark, f"{root}/out").count() == 240
    assert sev.batch_counters(spark, f"{root}/out").collect() == [(0, 240, 0)]


# -- batches in one pass -----------------------------------------------------------------------
def test_ingest_counts_each_batch_and_keeps_dead_letters(spark):
    root = scratch_path(spark, "counted")
    bad = [(1, "p", "%%"), (2, "p", None)]
    for i, rows in enumerate([[*bad, record(3, "o1", "2024-01-01T00:00:00.000Z")], bad[:1], [record(4, "o2", "2024-01-01T01:00:00.000Z")]]):
        spark.createDataFrame(rows, schemas.STREAM_RECORD).coalesce(1).write.parquet(f"{root}/src/{i}")
        sev.ingest(spark, f"{root}/src/*", f"{root}/out", f"{root}/ck")
        sev.ingest(spark, f"{root}/src/*", f"{root}/out", f"{root}/ck")  # nothing new: no batch
    got = sorted(tuple(r) for r in sev.batch_counters(spark, f"{root}/out").collect())
    assert got == [(0, 1, 2), (1, 0, 1), (2, 1, 0)]
    letters = sorted(((r.batch_id, r.seq, r.data) for r in sev.dead_letters(spark, f"{root}/out").collect()), key=str)
    assert letters == [(0, 1, "%%"), (0, 2, None), (1, 1, "%%")]
    assert sev.item_view(spark, f"{root}/out").count() == 2
    assert sev.batch_counters(spark, f"{root}/none").count() == sev.dead_letters(spark, f"{root}/none").count() == 0


# -- steps matched by state --------------------------------------------------------------------
def record(seq, order, at, kind="order_placed"):
    body = {"event_id": f"e{seq}", "order_id": order, "customer_id": "c", "event_type": kind, "status": "s", "timestamp": at}
    return (seq, order, base64.b64encode(json.dumps(body).encode()).decode())


def test_steps_are_matched_over_restarts(spark):
    root = scratch_path(spark, "steps")
    placed, confirmed = "order_placed", "order_confirmed"
    landings = [
        [record(1, "a", "2024-01-01T10:00:00.000Z"), record(2, "b", "2024-01-01T10:00:00.500+00:00"),
         record(3, "c", "2024-01-01T12:00:00.000+02:00"), record(4, "x", "2024-01-01T10:30:00.000Z", confirmed)],
        [record(1, "a", "2024-01-01T10:00:00.000Z"),  # again
         record(5, "a", "2024-01-01T10:50:00.000Z", confirmed), record(6, "c", "2024-01-01T11:00:00.001Z", confirmed),
         record(7, "d", "2024-01-01T10:55:00.000Z")],
        [record(5, "a", "2024-01-01T10:50:00.000Z", confirmed),  # again
         record(8, "e", "2024-01-01T20:00:00.000Z"), record(9, "d", "2024-01-01T11:00:00.000Z", confirmed),
         record(10, "y", "2024-01-01T20:00:00.000Z", confirmed)]]
    seen = []
    for i, rows in enumerate(landings):  # each call is a new query that goes on from the state of the one before
        spark.createDataFrame(rows, schemas.STREAM_RECORD).write.parquet(f"{root}/src/{i}")
        steps.follow(spark, f"{root}/src/*", f"{root}/out", f"{root}/ck", step=placed, following=confirmed, limit="1 hour")
        seen.append(sorted((r.order_id, r.seconds) for r in steps.followed(spark, f"{root}/out").where("seconds IS NOT NULL").collect()))
    assert seen == [[], [("a", 3000.0)], [("a", 3000.0), ("d", 300.0)]]
    late = {(r.order_id, r.step_at) for r in steps.followed(spark, f"{root}/out").where("seconds IS NULL").collect()}
    assert late == {("b", dt.datetime(2024, 1, 1, 10, 0, 0, 500000)), ("c", dt.datetime(2024, 1, 1, 10))}  # e is still open
    assert steps.followed(spark, f"{root}/none").count() == 0


# -- lines that do not fit ---------------------------------------------------------------------
def test_split_bronze_keeps_every_line(spark):
    root = scratch_path(spark, "checked")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
    lines = ["1,x,y", "2,x", "3,x,y,z", '4,"x,y', '5,"x,1",y', "only", ",,", "6,ü,"]
    spark.createDataFrame([(v,) for v in lines], "value string").repartition(3).write.text(f"{root}/in")
    counts = io.split_bronze(spark, f"{root}/in", f"{root}/out", schema=schema, header=False)
    good, bad = io.read_split(spark, f"{root}/out", schema=schema)
    assert counts == {"good": 4, "quarantined": 4} and good.count() + bad.count() == len(lines)
    assert sorted(r.line for r in bad.collect()) == sorted(["2,x", "3,x,y,z", '4,"x,y', "only"])
    assert all(r.file.endswith(".txt") for r in bad.collect())
    assert sorted((tuple(r) for r in good.collect()), key=str) == sorted(
        [("1", "x", "y"), ("5", "x,1", "y"), ("6", "ü", None), (None, None, None)], key=str)
    # headers of each file are skipped, and a good folder leaves an empty quarantine
    spark.createDataFrame([("1", "x", "y")], schema).write.option("header", True).csv(f"{root}/fine")
    assert io.split_bronze(spark, f"{root}/fine", f"{root}/fine_out", schema=schema) == {"good": 1, "quarantined": 0}
    assert io.read_split(spark, f"{root}/fine_out", schema=schema)[1].count() == 0
