"""One assertion per scalar function, edge cases included."""

import datetime as dt

from pyspark.sql import functions as F

from sparklake.functions import json as js
from sparklake.functions import scalar as sc


def one(spark, expr, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


def test_string_functions(spark):
    assert one(spark, F.trim(F.upper(F.col("s"))), "s string", ("  chile ",)) == "CHILE"      # H1
    assert one(spark, F.substring("s", 1, 3), "s string", ("SCL-LIM",)) == "SCL"             # H2
    assert one(spark, F.concat(F.lit("ORDER#"), "s"), "s string", ("o1",)) == "ORDER#o1"     # H19
    assert one(spark, F.concat(F.lit("ORDER#"), "s"), "s string", (None,)) is None           # H19 NULL key


def test_datetime_functions(spark):
    ts = dt.datetime(2025, 3, 16, 14, 5, 9, 123000)  # a Sunday
    sch, row = "t timestamp_ntz", (ts,)
    assert one(spark, sc.year_month("t"), sch, row) == "2025-03"                          # H3
    assert one(spark, sc.clock_time("t"), sch, row) == "14:05:09"                         # H4
    assert one(spark, sc.month_start("t"), sch, row) == dt.date(2025, 3, 1)               # H5
    assert one(spark, F.dayofmonth("t"), sch, row) == 16                                  # H6
    assert one(spark, sc.dow_sunday0("t"), sch, row) == 0                                 # H7
    later = F.col("t") + F.expr("INTERVAL 30 MINUTES 1 SECOND")
    assert one(spark, sc.epoch_minutes_between(F.col("t"), later), sch, row) == 30 + 1 / 60  # H8
    assert one(spark, F.date_add(F.col("t").cast("date"), 1), sch, row) == dt.date(2025, 3, 17)  # H9
    assert one(spark, sc.micros_between(F.col("t"), later) > 30 * 60_000_000, sch, row)   # H10
    assert one(spark, F.col("s").try_cast("timestamp_ntz"), "s string", ("2025-99-01",)) is None  # H11
    assert one(spark, F.month("t"), sch, row) == 3                                        # H12
    assert one(spark, sc.iso_ms("t"), sch, row) == "2025-03-16T14:05:09.123Z"             # H24


def test_in_month_is_half_open(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 31),), (dt.date(2025, 2, 1),), (dt.date(2025, 2, 28),),
                                (dt.date(2025, 3, 1),)], "d date")
    got = [r["d"].day for r in df.filter(sc.in_month("d", "2025-02")).orderBy("d").collect()]
    assert got == [1, 28]                                                                 # B11


def test_numeric_functions(spark):
    assert one(spark, sc.round_half_up(F.lit(54.85), 1)) == 54.9                         # H14
    assert one(spark, sc.round_half_up(F.lit(2.675), 2)) == 2.68                          # H14 binary trap
    assert one(spark, F.col("x") % 7, "x int", (30,)) == 2                                # H17
    assert one(spark, sc.pct(F.lit(1), F.lit(3))) == 100.0 / 3                            # H17 double division
    assert one(spark, F.floor(F.lit(-2.5)).cast("int")) == -3                             # H18 floor, not truncate


def test_conditional_functions(spark):
    assert one(spark, F.nullif(F.col("x"), F.lit(0)), "x int", (0,)) is None              # H15
    assert one(spark, F.coalesce(F.col("x"), F.lit(0)), "x int", (None,)) == 0            # H16
    assert one(spark, sc.status_of_event("e"), "e string", ("order_shipped",)) == "shipped"  # H25
    assert one(spark, sc.status_of_event("e"), "e string", ("order_lost",)) is None       # H25 unknown


def test_json_functions(spark):
    assert one(spark, js.decode_base64_text("s"), "s string", ("%%%",)) is None           # H20
    assert one(spark, js.decode_base64_text("s"), "s string", ("eyJhIjoxfQ==",)) == '{"a":1}'  # H20
    m = js.json_map("s")
    assert one(spark, m["a"], "s string", ('{"a": 12}',)) == "12"                         # H21/H23
    assert one(spark, m, "s string", ("not json",)) is None                               # H21
    assert one(spark, js.field_or_default(m, "p", ""), "s string", ('{"a": 1}',)) == ""   # H22 missing
    assert one(spark, js.field_or_default(m, "p", ""), "s string", ('{"p": null}',)) is None  # H22 null


def test_current_time_and_stable_id(spark):
    assert one(spark, F.current_timestamp().isNotNull())                                  # H13
    a = one(spark, sc.stable_id("s", "x"), "s string, x int", ("k", 1))
    b = one(spark, sc.stable_id("s", "x"), "s string, x int", ("k", 1))
    assert a == b and len(a) == 64                                                        # H26
