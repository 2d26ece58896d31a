"""Values worked out by hand: a few flights, and the 30 events of the seed log."""

import datetime as dt

from fixtures import hand_flights, seed_log

from sparklake.plans import flights as fl

D = dt.date


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_ranks(spark):
    r = rows(fl.cancellations_rank(hand_flights(spark)))
    assert sorted((x["month"], x["route"], x["cancellations"], x["ranking"]) for x in r) == [
        ("2025-01", "A", 2, 1), ("2025-01", "B", 1, 2), ("2025-02", "A", 3, 1)]
    v = {(x["month"], x["route"]): (x["rank"], x["dense_rank"], x["row_num"]) for x in rows(fl.rank_variants(hand_flights(spark)))}
    assert v[("2025-01", "B")] == (2, 2, 2)


def test_sliding_windows(spark):
    f = hand_flights(spark)
    r = {(x["route"], x["flight_date"]): x for x in rows(fl.sliding_occupancy(f))}
    assert len(r) == 11  # cancelled flights don't operate
    assert [r[("A", D(2025, 1, d))]["occupancy_avg_7"] for d in (1, 3, 5)] == [50.0, 75.0, 58.33]
    assert r[("A", D(2025, 1, 5))]["rows_in_window"] == 3
    s = {(x["route"], x["flight_date"]): x for x in rows(fl.sliding_stats(f))}[("A", D(2025, 2, 10))]
    assert (s["avg_7"], s["min_7"], s["max_7"]) == (52.08, 25.0, 100.0)
    by_day = {(x["route"], x["flight_date"]): (x["occupancy_avg_7d"], x["rows_in_range"]) for x in rows(fl.range_occupancy(f))}
    assert by_day[("A", D(2025, 1, 5))] == (58.33, 3) and by_day[("A", D(2025, 2, 10))] == (33.33, 1)


def test_month_over_month(spark):
    m = {(x["route"], x["month"]): x for x in rows(fl.mom_change(hand_flights(spark)))}
    assert set(m) == {("A", "2025-01"), ("A", "2025-02"), ("B", "2025-01")}
    assert (m[("A", "2025-01")]["variation_pct"], m[("A", "2025-01")]["trend"]) == (None, "PEOR")
    assert (m[("A", "2025-02")]["variation_pct"], m[("A", "2025-02")]["trend"]) == (50.0, "PEOR")
    assert [(x["route"], x["variation_pct"]) for x in rows(fl.worsened_over(hand_flights(spark), 20))] == [("A", 50.0)]


def test_running_and_calendar(spark):
    f = hand_flights(spark)
    t = {x["flight_date"]: x for x in rows(fl.running_total(f, "2025-01")) if x["route"] == "A"}
    assert [t[D(2025, 1, d)]["running_passengers"] for d in (1, 3, 5)] == [90, 270, 315]
    assert {x["total_month"] for x in t.values()} == {315} and t[D(2025, 1, 1)]["pct_of_total"] == 28.6
    c = sorted((x["flight_date"].day, x["status"], x["running_count"]) for x in rows(fl.running_count(f, "A", "2025-01-01", "2025-01-31")))
    assert c == [(1, "COMPLETED", 1), (2, "CANCELLED", 1), (3, "COMPLETED", 2), (5, "DELAYED", 1), (9, "CANCELLED", 2)]
    cal = rows(fl.calendar_activity(f, "A", "2025-01-01", "2025-01-05"))
    assert sorted((x["day"].day, x["flights_of_day"], x["day_status"]) for x in cal) == [
        (1, 1, "OPERATIVO"), (2, 0, "SIN OPERACION"), (3, 1, "OPERATIVO"), (4, 0, "SIN OPERACION"), (5, 1, "OPERATIVO")]
    grid = rows(fl.route_day_grid(f))
    assert len(grid) == 3 * 59 and sum(x["flights"] for x in grid) == 17


def test_latest_and_baselines(spark):
    f = hand_flights(spark)
    last = {x["route"]: (x["last_flight"], x["passengers"]) for x in rows(fl.last_flight_per_route(f))}
    assert last == {"A": (D(2025, 2, 10), 60), "B": (D(2025, 2, 28), 108), "C": (D(2025, 2, 1), 54)}
    assert len(rows(fl.latest_per_group(f))) == 6
    b = rows(fl.first_last_baseline(f, "A", "2025-01"))
    assert {(x["first_flight_pct"], x["last_flight_pct"]) for x in b} == {(50.0, 25.0)}
    assert sorted(x["diff_vs_first"] for x in b) == [-25.0, 0.0, 50.0]
    n = {x["route"]: x["nth_flight_pct"] for x in rows(fl.nth_value_baseline(f, 3, "2025-02"))}
    assert n == {"A": None, "B": 60.0, "C": None}
    q = {x["passengers"]: x["quartile"] for x in rows(fl.ntile_labels(f, "2025-01"))}
    assert q == {180: 1, 144: 1, 126: 2, 90: 2, 45: 3, 18: 4}


def test_subqueries(spark):
    f = hand_flights(spark)
    r = {x["route"]: (x["first_cancellation"], x["last_cancellation"]) for x in rows(fl.first_last_cancellation(f))}
    assert r == {"A": (D(2025, 1, 2), D(2025, 2, 3)), "B": (D(2025, 1, 1), D(2025, 1, 1))}
    assert [x["route"] for x in rows(fl.fully_cancelled_days(f))] == ["A"]  # B flew on its cancelled day
    lb = {x["flight_date"]: x["cancellations_7d"] for x in rows(fl.lookback_count(f, "A", "2025-01-09", "2025-02-10"))}
    assert lb == {D(2025, 1, 9): 1, D(2025, 2, 1): 0, D(2025, 2, 2): 1, D(2025, 2, 3): 2, D(2025, 2, 10): 1}
    above = {x["route"]: x["cancellation_rate_pct"] for x in rows(fl.above_average_rate(f))}
    assert above == {"A": 55.56}
    assert fl.never_completed(f, "2025-02").count() == 0
    assert [x["carrier"] for x in rows(fl.never_completed(f.filter("id <> 9"), "2025-02"))] == ["A"]


def test_gaps_golden(spark):
    log = seed_log(spark)
    rep = rows(fl.gap_report(log))
    assert len(rep) == 4
    assert sorted(x["minutes_idle"] for x in rep) == [42.4, 54.9, 96.5, 130.8]
    s = rows(fl.gap_summary(log))[0]
    assert (s["total_gaps"], s["longest_gap_min"], s["total_idle_min"]) == (4, 130.8, 324.6)
    durations = sorted(round(x["minutes_idle"] * 60) for x in rows(fl.gap_detection(log)))
    assert durations == [42 * 60 + 25, 54 * 60 + 51, 96 * 60 + 32, 130 * 60 + 50]
