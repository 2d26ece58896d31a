"""Band lookbacks and recursion against brute force: edges, hot keys, NULLs, many ranges."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sparklake.operators.bands import band_pairs, band_totals
from sparklake.operators.recursion import TooDeep, fixpoint
from sparklake.plans import flights as fl

START = dt.datetime(2024, 1, 1)
HOUR = 3_600_000_000


@pytest.fixture(scope="module")
def points():
    rng = random.Random(3)
    keys = ["hot"] * 6 + ["a", "b", None, "only probes"]
    probes, facts = [], []
    for i in range(400):  # whole hours, so that the edges of bands are met exactly
        at = None if i % 50 == 7 else START + dt.timedelta(hours=rng.randrange(200))
        probes.append((i, rng.choice(keys), at))
    for i in range(500):
        at = None if i % 60 == 7 else START + dt.timedelta(hours=rng.randrange(200))
        facts.append((rng.choice(keys[:-1]), at, None if i % 9 == 0 else rng.randrange(-50, 50)))
    return probes, facts + facts[:40]


def frames(spark, points):
    return (spark.createDataFrame(points[0], "id int, k string, at timestamp_ntz"),
            spark.createDataFrame(points[1], "k string, at timestamp_ntz, v int").withColumn(
                "v", F.col("v").cast("decimal(10,2)")))


@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("ranges", [1, 2, 17, 300])
def test_band_totals(spark, points, inclusive, ranges):
    probes, facts = frames(spark, points)
    got = band_totals(probes, facts, ["k"], "at", "at", 36 * HOUR, count="n", sums={"total": "v"}, inclusive=inclusive,
                      num_ranges=ranges)
    assert got.columns == ["id", "k", "at", "n", "total"]
    want = []
    for i, k, at in points[0]:
        met = [] if k is None or at is None else [
            v for fk, fat, v in points[1] if fk == k and fat is not None
            and at - dt.timedelta(hours=36) <= fat and (fat <= at if inclusive else fat < at)]
        values = [v for v in met if v is not None]
        want.append((i, k, at, len(met), sum(values) if values else None))
    assert sorted(((r.id, r.k, r["at"], r.n, None if r.total is None else int(r.total)) for r in got.collect()), key=str) == sorted(want, key=str)


def test_band_totals_of_repeated_and_no_rows(spark, points):
    probes, facts = frames(spark, points)
    same = probes.where("id = 1").unionAll(probes.where("id = 1"))
    got = [tuple(r) for r in band_totals(same, facts, ["k"], "at", "at", HOUR).collect()]
    assert len(got) == 2 and got[0] == got[1]
    assert band_totals(probes.limit(0), facts, ["k"], "at", "at", HOUR).count() == 0
    assert {r.n for r in band_totals(probes, facts.limit(0), ["k"], "at", "at", HOUR).collect()} == {0}


def test_band_pairs(spark, points):
    probes, facts = frames(spark, points)
    named = facts.select("k", F.col("at").alias("fact_at"), "v")
    got = band_pairs(probes, named, ["k"], "at", "fact_at", 36 * HOUR)
    want = [(i, k, at, fat, v) for i, k, at in points[0] for fk, fat, v in points[1]
            if k is not None and fk == k and at and fat and at - dt.timedelta(hours=36) <= fat < at]
    assert sorted(((r.id, r.k, r["at"], r.fact_at, None if r.v is None else int(r.v)) for r in got.collect()), key=str) == sorted(want, key=str)


def test_band_join_is_an_equal_join_by_bin(spark, points):
    probes, facts = frames(spark, points)
    plan = band_pairs(probes, facts.withColumnRenamed("at", "fact_at"), ["k"], "at", "fact_at", HOUR)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_fixpoint_ends_on_a_cycle_and_keeps_nulls(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (5, None)], "a int, b int")

    def onward(pairs):
        return pairs.join(edges.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b"))
    got = {tuple(r) for r in fixpoint(edges, onward).collect()}
    assert got == {(a, b) for a in (1, 2, 3) for b in (1, 2, 3, 4)} | {(5, None)}
    with pytest.raises(TooDeep):
        fixpoint(spark.createDataFrame([(1,)], "n int"), lambda d: d.select(F.col("n") + 1), most_levels=5)
    assert fixpoint(edges.limit(0), onward).count() == 0


def test_recursive_series_and_its_depth(spark):
    days = [("a", dt.date(2020, 1, 1)), ("a", dt.date(2024, 3, 1)), ("b", dt.date(2020, 2, 29)), ("c", None),
            ("d", dt.date(2020, 1, 1)), ("d", dt.date(2020, 2, 1)), (None, dt.date(2021, 1, 1))]
    f = spark.createDataFrame(days, "route string, flight_date date")
    want = sorted(map(str, fl.route_date_series(f).collect()))
    assert sorted(map(str, fl.recursive_date_series(f).collect())) == want
    assert sorted(map(str, fl.date_series_steps(f).collect())) == want
    with pytest.raises(Exception, match="RECURSION_LEVEL"):
        fl.recursive_date_series(f, levels=2).collect()
    with pytest.raises(TooDeep):
        fl.date_series_steps(f, levels=2).collect()
