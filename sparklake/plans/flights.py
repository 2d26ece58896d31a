"""Analytic reports over a flight table (id, route, flight_date, status,
passengers, capacity, carrier) and a system log (event_id, ts, system, severity).

Each function is DataFrame -> DataFrame.  Month/route parameters default to
values that exist in the driver's adapter data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparklake.functions.scalar import (
    DAY_ACTIVE, DAY_IDLE, QUARTILE_LABELS, TREND_BETTER, TREND_SAME, TREND_WORSE,
    clock_time, dow_sunday0, epoch_minutes_between, in_month, micros_between,
    month_start, pct, round_half_up, year_month)
from sparklake.operators.bands import band_pairs, band_totals
from sparklake.operators.dedup import distinct_on, latest_by_key
from sparklake.operators.joins import small
from sparklake.operators.ordered import (global_lead, global_ntile, keyed_position, keyed_shift,
                                         keyed_sliding)
from sparklake.operators.recursion import fixpoint

CANCELLED, DELAYED, COMPLETED = "CANCELLED", "DELAYED", "COMPLETED"

# Default parameters for the adapter data (orders span 1995-2001).
MONTH_A = "1996-01"
MONTH_B = "1996-02"
ROUTE = "1-URGENT"
LOOKBACK_FROM, LOOKBACK_TO = "1996-01-08", "1996-01-31"


def _d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def occupancy(f: DataFrame) -> F.Column:
    return pct("passengers", "capacity")


# -- K9 / K10: monthly cancellations and ranks ------------------------------
def monthly_cancellations(f: DataFrame) -> DataFrame:
    return (f.filter(F.col("status") == CANCELLED)
             .groupBy("route", month_start("flight_date").alias("month"))
             .agg(F.count(F.lit(1)).alias("cancellations")))


def cancellations_rank(f: DataFrame, k: int = 3) -> DataFrame:
    """Top-k routes by cancellations per month, ties kept (RANK)."""
    w = Window.partitionBy("month").orderBy(F.col("cancellations").desc())
    return (monthly_cancellations(f)
            .withColumn("ranking", F.rank().over(w))
            .filter(F.col("ranking") <= k)
            .select(year_month("month").alias("month"), "route", "cancellations",
                    F.col("ranking").cast("bigint").alias("ranking")))


def rank_variants(f: DataFrame) -> DataFrame:
    """RANK, DENSE_RANK and ROW_NUMBER side by side (route breaks row ties)."""
    w = Window.partitionBy("month").orderBy(F.col("cancellations").desc())
    w_rn = Window.partitionBy("month").orderBy(F.col("cancellations").desc(), F.col("route"))
    return (monthly_cancellations(f).select(
        year_month("month").alias("month"), "route", "cancellations",
        F.rank().over(w).cast("bigint").alias("rank"),
        F.dense_rank().over(w).cast("bigint").alias("dense_rank"),
        F.row_number().over(w_rn).cast("bigint").alias("row_num")))


# -- K11 / K12 / E14: sliding occupancy -------------------------------------
def _operated(f: DataFrame) -> DataFrame:
    return f.filter(F.col("status") != CANCELLED)


def _sliding(f: DataFrame, aggs: dict) -> DataFrame:
    """ROWS 6 PRECEDING per route via range partitioning + halo: a route with a
    third of all flights is split over many tasks (``keyed_sliding``).  All
    functions in ``aggs`` share one window spec (the named-window idea: one
    sort serves them all)."""
    base = _operated(f).select("route", "flight_date", "id", "passengers", "capacity",
                               occupancy(f).alias("_occ"))
    return keyed_sliding(base, ["route"], ["flight_date", "id"], 6, aggs)


def sliding_occupancy(f: DataFrame) -> DataFrame:
    out = _sliding(f, {"_avg": lambda w: F.avg("_occ").over(w),
                       "rows_in_window": lambda w: F.count(F.lit(1)).over(w)})
    return out.select("route", "flight_date", "id", "passengers", "capacity",
                      round_half_up("_occ", 2).alias("occupancy_pct"),
                      round_half_up("_avg", 2).alias("occupancy_avg_7"), "rows_in_window")


def sliding_stats(f: DataFrame) -> DataFrame:
    out = _sliding(f, {"_avg": lambda w: F.avg("_occ").over(w),
                       "_min": lambda w: F.min("_occ").over(w),
                       "_max": lambda w: F.max("_occ").over(w)})
    return out.select("route", "flight_date", "id", round_half_up("_occ", 2).alias("occupancy_pct"),
                      round_half_up("_avg", 2).alias("avg_7"), round_half_up("_min", 2).alias("min_7"),
                      round_half_up("_max", 2).alias("max_7"))


def range_occupancy(f: DataFrame, days: int = 6) -> DataFrame:
    """Logical frame: rows whose date lies within ``days`` days back (gaps respected).

    The RANGE frame is evaluated on one row per (route, day) (a map-side
    combined aggregate), then joined back to the flights, so the window never
    holds raw rows.
    """
    base = _operated(f).select("route", "flight_date", "id", occupancy(f).alias("_occ"))
    daily = base.groupBy("route", "flight_date").agg(
        F.sum("_occ").alias("_s"), F.count("_occ").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    w = (Window.partitionBy("route").orderBy(F.unix_date("flight_date"))
         .rangeBetween(-days, Window.currentRow))
    per_day = daily.select("route", "flight_date",
                           round_half_up(F.sum("_s").over(w) / F.sum("_n").over(w), 2).alias("occupancy_avg_7d"),
                           F.sum("_rows").over(w).alias("rows_in_range"))
    return base.join(small(per_day), ["route", "flight_date"]).select(
        "route", "flight_date", "id", "occupancy_avg_7d", "rows_in_range")


# -- bands of hours on raw events ---------------------------------------------
BAND_HOURS = 36
_HOUR = 3_600_000_000  # microseconds


def signups_before_errors(log: DataFrame, hours: int = BAND_HOURS) -> DataFrame:
    """Per ERROR event: how many WARN events the same user had in the ``hours`` before."""
    errors = log.where("severity = 'ERROR'").select("event_id", "user_id", "ts")
    warnings = log.where("severity = 'WARN'").select("user_id", "ts")
    return band_totals(errors, warnings, ["user_id"], "ts", "ts", hours * _HOUR, count="warnings_before")


def events_in_reach(log: DataFrame, hours: int = BAND_HOURS) -> DataFrame:
    """Logical frame on timestamps: events of the same system in the ``hours`` up to each event, and the sum of their user ids."""
    rows = log.select("event_id", "system", "ts")
    facts = log.select("system", "ts", F.col("user_id").cast("decimal(20,0)").alias("user_id"))
    out = band_totals(rows, facts, ["system"], "ts", "ts", hours * _HOUR, count="events_in_range", sums={"_users": "user_id"},
                      inclusive=True)
    return out.select("event_id", "system", "events_in_range", F.col("_users").cast("bigint").alias("user_id_sum"))


def warned_errors(log: DataFrame, hours: int = BAND_HOURS) -> DataFrame:
    """Pairs of an ERROR event and a WARN event of the same user in the ``hours`` before it, with the minutes between."""
    errors = log.where("severity = 'ERROR'").select("event_id", "user_id", "ts")
    warnings = log.where("severity = 'WARN'").select("user_id", F.col("event_id").alias("warning_id"), F.col("ts").alias("warned_at"))
    pairs = band_pairs(errors, warnings, ["user_id"], "ts", "warned_at", hours * _HOUR)
    return pairs.select("user_id", "event_id", "warning_id", F.floor(micros_between("warned_at", "ts") / 60_000_000).alias("minutes_between"))


# -- K13-K15: gaps in a global event order -----------------------------------
def gaps(log: DataFrame, threshold_minutes: float = 30, by: str | None = None) -> DataFrame:
    """Consecutive events (ordered by ts, event_id) more than ``threshold`` apart.

    Global order uses the range-partitioned lead (no single-partition window);
    ``by`` gives gaps per key instead.
    """
    order = ["ts", "event_id"]
    log = log.select("event_id", "ts", "system", *([by] if by and by != "system" else []))
    if by is None:
        led = global_lead(log, order, ["ts", "event_id"])
    else:
        led = keyed_shift(log, [by], order, ["ts", "event_id"], direction="lead")
    limit = int(threshold_minutes * 60_000_000)
    return led.filter(micros_between("ts", "next_ts") > limit)


def gap_detection(log: DataFrame, threshold_minutes: float = 30) -> DataFrame:
    g = gaps(log, threshold_minutes)
    return g.select(F.col("ts").alias("gap_start"), F.col("next_ts").alias("gap_end"), "system",
                    epoch_minutes_between("ts", "next_ts").alias("minutes_idle"))


def gap_report(log: DataFrame, threshold_minutes: float = 30) -> DataFrame:
    g = gaps(log, threshold_minutes)
    return g.select(
        F.col("event_id").alias("event_start"), F.col("next_event_id").alias("event_end"), "system",
        clock_time("ts").alias("start_time"), clock_time("next_ts").alias("end_time"),
        round_half_up(epoch_minutes_between("ts", "next_ts"), 1).alias("minutes_idle"))


def gap_summary(log: DataFrame, threshold_minutes: float = 30) -> DataFrame:
    g = gaps(log, threshold_minutes).select(micros_between("ts", "next_ts").alias("us"))
    return g.agg(
        F.count(F.lit(1)).alias("total_gaps"),
        round_half_up(F.max("us") / F.lit(60_000_000.0), 1).alias("longest_gap_min"),
        round_half_up(F.sum("us") / F.lit(60_000_000.0), 1).alias("total_idle_min"))


# -- K16 / K17 / E6: month over month ---------------------------------------
def densify_months(m: DataFrame) -> DataFrame:
    """Every month between a route's first and last month, zero-filled (C9)."""
    span = m.groupBy("route").agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    grid = span.select("route", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH")))
                       .alias("month"))
    return (grid.join(m, ["route", "month"], "left")
                .withColumn("cancellations", F.coalesce("cancellations", F.lit(0)).cast("bigint")))


def mom_change(f: DataFrame, calendar: bool = False) -> DataFrame:
    m = monthly_cancellations(f)
    if calendar:
        m = densify_months(m)
    w = Window.partitionBy("route").orderBy("month")
    cur, prev = F.col("cancellations"), F.col("prev_cancellations")
    out = m.withColumn("prev_cancellations", F.lag("cancellations").over(w))
    change = F.when(prev.isNull(), F.lit(None).cast("double")).otherwise(
        round_half_up(F.lit(100.0) * (cur - prev) / F.nullif(prev, F.lit(0)).cast("double"), 1))
    trend = (F.when(cur > F.coalesce(prev, F.lit(0)), TREND_WORSE)
              .when(cur < prev, TREND_BETTER).otherwise(TREND_SAME))
    return out.select("route", year_month("month").alias("month"), "cancellations",
                      "prev_cancellations", change.alias("variation_pct"), trend.alias("trend"))


def worsened_over(f: DataFrame, threshold: float = 20) -> DataFrame:
    return (mom_change(f).filter(F.col("variation_pct") > threshold)
            .select("route", "month", "cancellations", "prev_cancellations", "variation_pct"))


def lag_default(f: DataFrame, default: int = 0) -> DataFrame:
    w = Window.partitionBy("route").orderBy("month")
    return monthly_cancellations(f).select(
        "route", year_month("month").alias("month"), "cancellations",
        F.lag("cancellations", 1, default).over(w).cast("bigint").alias("prev_or_default"))


# -- K18-K20: running totals and calendars ----------------------------------
def running_total(f: DataFrame, month: str = MONTH_A) -> DataFrame:
    """Running passengers per route (default RANGE frame: same-day peers share
    the value), the month total and the share reached.

    Evaluated on one row per (route, day), combined map-side, then joined back:
    the window holds days, not flights, so a busy route is not one huge task.
    """
    base = _operated(f).filter(in_month("flight_date", month)).select(
        "route", "flight_date", "id", "passengers")
    daily = base.groupBy("route", "flight_date").agg(F.sum("passengers").alias("_p"))
    upto = Window.partitionBy("route").orderBy("flight_date").rowsBetween(Window.unboundedPreceding,
                                                                          Window.currentRow)
    run, tot = F.sum("_p").over(upto), F.sum("_p").over(Window.partitionBy("route"))
    per_day = daily.select("route", "flight_date", run.cast("bigint").alias("running_passengers"),
                           tot.cast("bigint").alias("total_month"),
                           round_half_up(F.lit(100.0) * run / tot, 1).alias("pct_of_total"))
    return base.join(small(per_day), ["route", "flight_date"]).select(
        "route", "flight_date", "id", "passengers", "running_passengers", "total_month", "pct_of_total")


def running_count(f: DataFrame, route: str = ROUTE, start: str = "1996-01-01",
                  end: str = "1996-01-31") -> DataFrame:
    """Running count per (route, status) over ROWS UNBOUNDED PRECEDING, as a
    keyed position (hot keys split over ranges)."""
    base = f.filter(F.col("flight_date").between(F.lit(_d(start)), F.lit(_d(end)))
                    & (F.col("route") == route)).select("flight_date", "route", "status", "id")
    return keyed_position(base, ["route", "status"], ["flight_date", "id"], name="running_count")


def day_series(spark_df: DataFrame, start, end, name: str = "day") -> DataFrame:
    """Days from ``start`` to ``end`` inclusive (replaces a recursive CTE)."""
    return spark_df.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias(name))


def calendar_activity(f: DataFrame, route: str = ROUTE, start: str = "1996-01-01",
                      end: str = "1996-01-31") -> DataFrame:
    lo, hi = F.lit(_d(start)), F.lit(_d(end))
    days = day_series(f.sparkSession.range(1), lo, hi)
    # constant ON predicates become a pre-filter of the right side, then
    # the right side is reduced to one row per day before the join.
    daily = (f.filter((F.col("route") == route) & (F.col("status") != CANCELLED)
                      & F.col("flight_date").between(lo, hi))
              .groupBy(F.col("flight_date").alias("day"))
              .agg(F.count("id").alias("n"), F.sum("passengers").alias("p")))
    j = days.join(daily, "day", "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    return j.select("day", n.alias("flights_of_day"),
                    F.coalesce(F.col("p"), F.lit(0)).cast("bigint").alias("passengers_of_day"),
                    F.when(n == 0, DAY_IDLE).otherwise(DAY_ACTIVE).alias("day_status"))


def date_series(f: DataFrame) -> DataFrame:
    span = f.agg(F.min("flight_date").alias("lo"), F.max("flight_date").alias("hi"))
    return day_series(span, F.col("lo"), F.col("hi"))


def route_date_series(f: DataFrame) -> DataFrame:
    """Per route, every day from its first to its last flight (anchored series)."""
    span = f.groupBy("route").agg(F.min("flight_date").alias("lo"), F.max("flight_date").alias("hi"))
    return span.select("route", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY")))
                       .alias("day"))


#: Spans are halved until they have at most 31 days; 40 levels would hold any span that a date can have.
RECURSIVE_SERIES = """
WITH RECURSIVE spans (route, lo, hi) MAX RECURSION LEVEL {levels} AS (
  SELECT route, min(flight_date), max(flight_date) FROM {f} GROUP BY route
  UNION ALL
  SELECT s.route, half.lo, half.hi
  FROM (SELECT route, lo, hi, date_add(lo, CAST(datediff(hi, lo) DIV 2 AS INT)) AS mid FROM spans WHERE datediff(hi, lo) >= 31) s
  LATERAL VIEW inline(array(struct(lo AS lo, mid AS hi), struct(date_add(mid, 1) AS lo, hi AS hi))) half AS lo, hi)
SELECT route, explode(sequence(lo, hi, INTERVAL 1 DAY)) AS day FROM spans WHERE datediff(hi, lo) < 31"""


def recursive_date_series(f: DataFrame, levels: int = 40) -> DataFrame:
    """``route_date_series`` by a recursive query; beyond ``levels`` levels Spark raises.

    A day a level would be one job a day.  Each level halves the spans instead, so the depth is
    the logarithm of the days; the leaves, of at most a month, are spelled out.
    """
    return f.sparkSession.sql(RECURSIVE_SERIES, f=f.select("route", "flight_date"), levels=levels)


def date_series_steps(f: DataFrame, levels: int = 40) -> DataFrame:
    """The same series by semi-naive DataFrame steps; beyond ``levels`` levels ``TooDeep`` is raised."""
    span = f.groupBy("route").agg(F.min("flight_date").alias("lo"), F.max("flight_date").alias("hi"))
    mid = F.expr("date_add(lo, CAST(datediff(hi, lo) DIV 2 AS INT))")

    def halves(spans: DataFrame) -> DataFrame:
        return spans.where("datediff(hi, lo) >= 31").withColumn("mid", mid).select("route", F.inline(F.array(
            F.struct("lo", F.col("mid").alias("hi")), F.struct(F.date_add("mid", 1).alias("lo"), "hi"))))
    leaves = fixpoint(span, halves, most_levels=levels).where("datediff(hi, lo) < 31")
    return leaves.select("route", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))


def route_day_grid(f: DataFrame) -> DataFrame:
    """Routes x days over the whole span, with flights and passengers per cell.

    The day range is a scalar of its own; months are dealt out before they become days,
    so the grid (routes x calendar days) is made by many tasks.
    """
    span = f.agg(F.struct(F.min("flight_date").alias("lo"), F.max("flight_date").alias("hi")).alias("s"))
    spans = f.select("route").distinct().withColumn("_s", span.scalar())
    months = spans.select("route", "_s", F.explode(F.sequence(
        month_start("_s.lo"), month_start("_s.hi"), F.expr("INTERVAL 1 MONTH"))).alias("_m")).repartition("route", "_m")
    days = F.sequence(F.greatest("_m", "_s.lo"), F.least(F.last_day("_m"), "_s.hi"), F.expr("INTERVAL 1 DAY"))
    grid = months.select("route", F.explode(days).alias("day"))
    daily = (f.groupBy("route", F.col("flight_date").alias("day"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum("passengers").alias("p")))
    return grid.join(daily, ["route", "day"], "left").select(
        "route", "day", F.coalesce("n", F.lit(0)).alias("flights"),
        F.coalesce("p", F.lit(0)).cast("bigint").alias("passengers"))


# -- K21-K23: latest per group ----------------------------------------------
def latest_per_group(f: DataFrame) -> DataFrame:
    base = f.select("route", month_start("flight_date").alias("m"), "flight_date", "id",
                    "status", "passengers")
    last = latest_by_key(base, ["route", "m"], ["flight_date", "id"])
    return last.select("route", year_month("m").alias("month"),
                       F.col("flight_date").alias("last_flight"), "status", "passengers")


def first_last_cancellation(f: DataFrame) -> DataFrame:
    return (f.filter(F.col("status") == CANCELLED).groupBy("route")
             .agg(F.min("flight_date").alias("first_cancellation"),
                  F.max("flight_date").alias("last_cancellation")))


def last_flight_per_route(f: DataFrame) -> DataFrame:
    base = f.select("route", "flight_date", "id", "status", "passengers")
    return distinct_on(base, ["route"], ["flight_date", "id"]).select(
        "route", F.col("flight_date").alias("last_flight"), "status", "passengers")


# -- K24-K26: baselines and quartiles ----------------------------------------
def _month_key(f: DataFrame):
    return month_start("flight_date").alias("_m")


def first_last_baseline(f: DataFrame, route: str = ROUTE, month: str = MONTH_A) -> DataFrame:
    """First and last flight of the route-month as baseline (full-frame
    FIRST_VALUE / LAST_VALUE), as ``min_by`` / ``max_by`` aggregates joined back:
    combined map-side, whatever the size of a route-month."""
    base = (_operated(f).filter((F.col("route") == route) & in_month("flight_date", month))
            .select("route", "flight_date", "id", _month_key(f), occupancy(f).alias("_occ")))
    ordering = F.struct("flight_date", "id")
    ends = base.groupBy("route", "_m").agg(F.min_by("_occ", ordering).alias("_first"),
                                           F.max_by("_occ", ordering).alias("_last"))
    return base.join(small(ends), ["route", "_m"]).select(
        "route", "flight_date", "id", round_half_up("_occ", 2).alias("occupancy_pct"),
        round_half_up("_first", 2).alias("first_flight_pct"),
        round_half_up("_last", 2).alias("last_flight_pct"),
        round_half_up(F.col("_occ") - F.col("_first"), 2).alias("diff_vs_first"))


def nth_value_baseline(f: DataFrame, n: int = 3, month: str = MONTH_B) -> DataFrame:
    """NTH_VALUE(occupancy, n) over the full route-month.  ``row_number() = n``
    lets Catalyst put a map-side ``WindowGroupLimit`` (at most n rows per
    route-month leave each task); a month with fewer rows gets NULL."""
    base = (_operated(f).filter(in_month("flight_date", month))
            .select("route", "flight_date", "id", _month_key(f), occupancy(f).alias("_occ")))
    w = Window.partitionBy("route", "_m").orderBy("flight_date", "id")
    nth = (base.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == n)
               .select("route", "_m", F.col("_occ").alias("_nth")))
    return base.join(small(nth), ["route", "_m"], "left").select(
        "route", "flight_date", "id", round_half_up("_occ", 2).alias("occupancy_pct"),
        round_half_up("_nth", 2).alias("nth_flight_pct"))


def ntile_labels(f: DataFrame, month: str = MONTH_A, k: int = 4) -> DataFrame:
    base = _operated(f).filter(in_month("flight_date", month)).select(
        "route", "flight_date", "id", "passengers", round_half_up(occupancy(f), 2).alias("occupancy_pct"))
    order = [F.col("passengers").desc_nulls_first(), F.col("flight_date"), F.col("id")]
    q = global_ntile(base, order, k, name="quartile")
    labels = F.create_map(*[x for kv in QUARTILE_LABELS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return q.withColumn("category", labels[F.col("quartile").cast("int")])


# -- K27-K30: subqueries as joins -------------------------------------------
def fully_cancelled_days(f: DataFrame) -> DataFrame:
    """Routes with a day on which every flight was cancelled (semi over anti)."""
    day = ["route", "flight_date"]
    cancelled = f.filter(F.col("status") == CANCELLED).select(*day).distinct()
    operated = _operated(f).select(*day).distinct()
    bad_days = cancelled.join(operated, day, "left_anti")
    return f.select(*day).distinct().join(bad_days, day, "left_semi").select("route").distinct()


def lookback_count(f: DataFrame, route: str = ROUTE, start: str = LOOKBACK_FROM,
                   end: str = LOOKBACK_TO, days: int = 7) -> DataFrame:
    """Per flight, cancellations of the same route in ``[d - days, d)``.

    The correlated band subquery becomes a RANGE window over one row per
    (route, day); history is cut to the dates the window can reach.
    """
    lo, hi = _d(start), _d(end)
    scope = (F.col("route") == route)
    hist = (f.filter(scope & F.col("flight_date").between(F.lit(lo - dt.timedelta(days=days)), F.lit(hi)))
             .groupBy("route", "flight_date")
             .agg(F.count_if(F.col("status") == CANCELLED).alias("c")))
    w = (Window.partitionBy("route").orderBy(F.unix_date("flight_date")).rangeBetween(-days, -1))
    per_day = hist.select("route", "flight_date",
                          F.coalesce(F.sum("c").over(w), F.lit(0)).cast("bigint").alias("cancellations_7d"))
    flights_ = f.filter(scope & F.col("flight_date").between(F.lit(lo), F.lit(hi)))
    return flights_.join(per_day, ["route", "flight_date"], "left").select(
        "route", "flight_date", "status", "id", "cancellations_7d")


def above_average_rate(f: DataFrame) -> DataFrame:
    """Routes whose cancellation rate beats the global rate.

    The global rate is a scalar subquery over the per-route aggregate.
    """
    per = f.groupBy("route").agg(F.count(F.lit(1)).alias("total_flights"),
                                 F.count_if(F.col("status") == CANCELLED).alias("cancelled"))
    overall = per.agg(pct(F.sum("cancelled"), F.sum("total_flights")).alias("rate")).scalar()
    return (per.withColumn("_rate", pct("cancelled", "total_flights")).filter(F.col("_rate") > overall)
               .select("route", "total_flights", "cancelled",
                       round_half_up("_rate", 2).alias("cancellation_rate_pct")))


def never_completed(f: DataFrame, month: str = MONTH_B, key: str = "carrier") -> DataFrame:
    in_m = f.filter(in_month("flight_date", month))
    done = in_m.filter(F.col("status") == COMPLETED).select(key).distinct()
    return in_m.select(key).distinct().join(done, key, "left_anti")


# -- K32 / A21: expression join, inline values -------------------------------
def crew_assignment(f: DataFrame, crew: DataFrame, roles=("BUILDING", "MACHINERY")) -> DataFrame:
    """Equi-join on a key computed from one side (``base = LEFT(route, 3)`` shape)."""
    members = crew.filter(F.col("c_mktsegment").isin(*roles)).select("c_name", "c_mktsegment")
    key = F.format_string("Customer#%09d", F.col("carrier"))
    return (f.select("id", "route", "carrier", key.alias("c_name"))
             .join(members, "c_name", "inner")
             .select("id", "route", "carrier", "c_name", F.col("c_mktsegment").alias("role")))


# Status vocabulary of the source system.
STATUS_NAMES_ES = [("COMPLETED", "COMPLETADO"), ("CANCELLED", "CANCELADO"), ("DELAYED", "DEMORADO")]


def status_translation(f: DataFrame) -> DataFrame:
    """An inline VALUES relation joined to per-status counts."""
    spark = f.sparkSession
    values = spark.createDataFrame(STATUS_NAMES_ES, "status string, status_es string")
    counts = f.groupBy("status").agg(F.count(F.lit(1)).alias("flights"))
    # the VALUES side is a literal list: broadcasting it is bounded by construction
    return counts.join(F.broadcast(values), "status", "left").select("status", "status_es", "flights")


# -- B: filters ---------------------------------------------------------------
def filter_between(f: DataFrame, start="1996-01-01", end="1996-03-31") -> DataFrame:
    return f.filter(F.col("flight_date").between(F.lit(_d(start)), F.lit(_d(end)))).select(
        "id", "route", "flight_date", "status")


def filter_in(f: DataFrame) -> DataFrame:
    return (f.filter(F.col("status").isin(CANCELLED, DELAYED) & dow_sunday0("flight_date").isin(5, 6))
             .select("id", "route", "flight_date", "status",
                     dow_sunday0("flight_date").alias("dow")))


def filter_month(f: DataFrame, month: str = MONTH_B) -> DataFrame:
    return f.filter(in_month("flight_date", month)).select("id", "route", "flight_date", "status")


#: One SQL form a method.  The NOT IN list carries a NULL for every cancelled flight.
MEMBERSHIP = {
    "in_subquery": "SELECT count(*) AS n FROM {c} WHERE c_custkey IN (SELECT carrier FROM {f})",
    "exists": "SELECT count(*) AS n FROM {c} c WHERE EXISTS (SELECT 1 FROM {f} f WHERE f.carrier = c.c_custkey)",
    "inner_join": "SELECT coalesce(sum(f.flights), 0) AS n FROM {c} c JOIN "
                  "(SELECT carrier, count(*) AS flights FROM {f} GROUP BY carrier) f ON f.carrier = c.c_custkey",
    "inner_join_distinct": "SELECT count(*) AS n FROM (SELECT DISTINCT c.c_custkey FROM {c} c JOIN "
                           "(SELECT DISTINCT carrier FROM {f}) f ON f.carrier = c.c_custkey)",
    "not_exists": "SELECT count(*) AS n FROM {c} c WHERE NOT EXISTS (SELECT 1 FROM {f} f WHERE f.carrier = c.c_custkey)",
    "not_in_nullable_list": "SELECT count(*) AS n FROM {c} c WHERE NOT EXISTS (SELECT 1 FROM {f} f WHERE f.status <=> {cancelled} "
                            "OR f.carrier IS NULL) AND (c_custkey IS NOT NULL OR NOT EXISTS (SELECT 1 FROM {f})) "
                            "AND NOT EXISTS (SELECT 1 FROM {f} f WHERE f.carrier = c.c_custkey)",
}


def in_exists_join_equivalence(f: DataFrame, customers: DataFrame) -> DataFrame:
    """IN vs EXISTS vs JOIN vs NOT IN / NOT EXISTS, as row counts per method.

    Customers that fly (carrier = c_custkey).  Each method is a SQL form of its own, which Spark
    plans for itself (semi, inner and anti joins).  The NOT IN list carries a NULL for
    every cancelled flight, so NOT IN returns nothing (three-valued logic) while NOT EXISTS returns the customers without
    flights.  Written as NOT IN, Spark broadcasts the whole list whatever its size; so it is
    spelled out: no NULL in the list, no NULL on the left unless the list is empty, and no equal in it.
    """
    flights = f.select("carrier", "status")
    out = None
    for method, sql in MEMBERSHIP.items():
        args = {"cancelled": CANCELLED} if "{cancelled}" in sql else {}
        one = f.sparkSession.sql(sql, c=customers.select("c_custkey"), f=flights, **args).select(
            F.lit(method).alias("method"), F.col("n").cast("bigint").alias("row_count"))
        out = one if out is None else out.unionAll(one)
    return out


# -- F: sorted reports ---------------------------------------------------------
def sorted_cancellations(f: DataFrame) -> tuple[DataFrame, list]:
    """Monthly cancellations with their order: month, then most cancellations first."""
    m = monthly_cancellations(f).select(year_month("month").alias("month"), "route", "cancellations")
    return m, [F.col("month"), F.col("cancellations").desc(), F.col("route")]


def sorted_mom(f: DataFrame) -> tuple[DataFrame, list]:
    """Month-over-month changes with their order: route, then month."""
    return mom_change(f), [F.col("route"), F.col("month")]
