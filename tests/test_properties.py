"""Property tests: the distributed global-order operators equal Spark's plain
windows on random data with ties, NULL keys, and tiny range counts."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparklake.operators.ordered import (global_lead, global_ntile, keyed_position, keyed_shift,
                                         keyed_sliding)

rows_st = st.lists(st.tuples(st.sampled_from(["h", "h", "h", "a", None]), st.integers(0, 4)),
                   min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st, ranges=st.integers(1, 12), k=st.integers(1, 5))
def test_ordered_operators_equal_plain_windows(spark, rows, ranges, k):
    df = spark.createDataFrame([(key, v, i) for i, (key, v) in enumerate(rows)], "k string, v int, id int")
    key = lambda r: str(r)

    got = global_ntile(df, [F.col("v").desc(), "id"], k, name="b", num_ranges=ranges)
    ref = df.withColumn("b", F.ntile(k).over(Window.orderBy(F.col("v").desc(), "id")).cast("bigint"))
    assert sorted(got.collect(), key=key) == sorted(ref.collect(), key=key)

    got = global_lead(df, ["v", "id"], ["id"], num_ranges=ranges).select("id", "next_id")
    ref = df.select("id", F.lead("id").over(Window.orderBy("v", "id")).alias("next_id"))
    assert sorted(got.collect(), key=key) == sorted(ref.collect(), key=key)

    wk = Window.partitionBy("k").orderBy("v", "id")
    got = keyed_shift(df, ["k"], ["v", "id"], ["v"], direction="lag", num_ranges=ranges).select("id", "prev_v")
    ref = df.select("id", F.lag("v").over(wk).alias("prev_v"))
    assert sorted(got.collect(), key=key) == sorted(ref.collect(), key=key)

    got = keyed_position(df, ["k"], ["v", "id"], name="p", num_ranges=ranges).select("id", "p")
    ref = df.select("id", F.row_number().over(wk).cast("bigint").alias("p"))
    assert sorted(got.collect(), key=key) == sorted(ref.collect(), key=key)

    got = keyed_sliding(df, ["k"], ["v", "id"], k, {"s": lambda w: F.sum("v").over(w)},
                        num_ranges=ranges).select("id", "s")
    ref = df.select("id", F.sum("v").over(wk.rowsBetween(-k, 0)).alias("s"))
    assert sorted(got.collect(), key=key) == sorted(ref.collect(), key=key)
