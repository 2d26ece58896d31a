"""Oracle SQL (DuckDB dialect) for every registered query with a SQL form.

The adapter views are re-stated as CTEs, so each statement reads only the
driver's pre-registered tables.  Column names equal the Spark outputs.
"""

from __future__ import annotations

from sparklake.sources.tables import TABLES

FLIGHTS = """flights AS (
  SELECT o_orderkey AS id, o_orderpriority AS route, CAST(o_orderdate AS DATE) AS flight_date,
         CASE o_orderstatus WHEN 'P' THEN 'CANCELLED' WHEN 'O' THEN 'DELAYED'
                            WHEN 'F' THEN 'COMPLETED' END AS status,
         CAST(floor(o_totalprice / 5000) AS INTEGER) AS passengers, 100 AS capacity,
         o_custkey AS carrier
  FROM orders)"""

SYSTEM_LOG = """system_log AS (
  SELECT event_id, ts, user_id, event_type AS system,
         CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'WARN'
              ELSE 'INFO' END AS severity
  FROM events)"""

_BRONZE_COLS = """CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         o_orderpriority AS product, CAST(1 + o_orderkey % 5 AS VARCHAR) AS quantity"""

_PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"
_CREATED = """CASE WHEN o_orderkey % 89 = 5 THEN 'not a date'
              WHEN o_orderkey % 89 <> 6 THEN CAST(o_orderdate AS VARCHAR) END"""

BRONZE_ORDERS = f"""bronze_orders AS (
  SELECT {_BRONZE_COLS},
         CASE o_orderkey % 97 WHEN 11 THEN '0.004' WHEN 12 THEN 'NaN' WHEN 13 THEN '1234567.25'
              WHEN 14 THEN 'abc' ELSE CAST({_PRICE} AS VARCHAR) END AS amount,
         concat(' ', lower(o_orderstatus), ' ') AS status,
         {_CREATED} AS created_at, CASE WHEN o_orderkey % 89 <> 7 THEN {_CREATED} END AS updated_at,
         CASE WHEN o_orderkey % 50 = 7 THEN NULL WHEN o_orderkey % 10 = 0 THEN 'D'
              WHEN o_orderkey % 10 <= 3 THEN 'U' ELSE 'I' END AS op
  FROM orders)"""


def _changes(name: str, where: str, amount: str, updated: str, op: str) -> str:
    return f"""{name} AS (
  SELECT {_BRONZE_COLS},
         CAST(CAST({_PRICE} + ({amount}) AS DECIMAL(18,2)) AS VARCHAR) AS amount,
         concat(' ', lower(o_orderstatus), ' ') AS status,
         CAST(o_orderdate AS VARCHAR) AS created_at, CAST({updated} AS VARCHAR) AS updated_at, {op} AS op
  FROM orders WHERE {where})"""


ORDER_CHANGES = _changes(
    "order_changes", "o_orderkey % 20 IN (3, 6)", "CASE WHEN o_orderkey % 40 = 3 THEN -1 ELSE 1 END",
    """CASE o_orderkey % 40 WHEN 3 THEN o_orderdate WHEN 26 THEN o_orderdate WHEN 6 THEN NULL
            ELSE o_orderdate + INTERVAL 1 DAY END""", "CASE WHEN o_orderkey % 20 = 3 THEN 'U' ELSE 'D' END")
ORDER_REINSERTS = _changes("order_reinserts", "o_orderkey % 80 = 26", "5", "o_orderdate", "'I'")

BRONZE_CUSTOMERS = """bronze_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
         concat(lower(c_name), '@example.com') AS email,
         concat(' ', lower(n_name), ' ') AS country,
         '2024-01-01 00:00:00' AS created_at,
         CASE WHEN c_custkey % 25 = 0 THEN 'D' ELSE 'I' END AS op
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

ORDER_EVENTS = """order_events AS (
  SELECT event_id,
         concat('o', CAST(ord AS VARCHAR)) AS order_id,
         ord % 50 AS customer_id,
         etype AS event_type,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE props END AS product,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(value AS VARCHAR) END AS amount,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS timestamp,
         event_id % 97 = 5 AS is_corrupt,
         event_id % 101 = 3 AS misses_order_id,
         CASE etype WHEN 'order_placed' THEN 'pending' WHEN 'order_confirmed' THEN 'confirmed'
                    WHEN 'order_shipped' THEN 'shipped' WHEN 'order_delivered' THEN 'delivered'
                    WHEN 'order_cancelled' THEN 'cancelled' END AS status
  FROM (SELECT *, CAST(floor(event_id / 4) AS BIGINT) AS ord,
               CASE event_id % 4 WHEN 0 THEN 'order_placed' WHEN 1 THEN 'order_confirmed'
                    WHEN 2 THEN CASE WHEN floor(event_id / 4) % 5 = 0 THEN 'order_cancelled'
                                     ELSE 'order_shipped' END
                    ELSE 'order_delivered' END AS etype
        FROM events) e
  WHERE NOT (event_id % 4 = 3 AND ord % 5 = 0 AND ord % 7 <> 0))"""


def rnd(expr: str, n: int) -> str:
    """Same rounding as ``functions.scalar.round_half_up``."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,9)), {n}) AS DOUBLE)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def ym(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m')"


MONTHLY_CANCEL = """monthly AS (
  SELECT route, CAST(date_trunc('month', flight_date) AS DATE) AS month, COUNT(*) AS cancellations
  FROM flights WHERE status = 'CANCELLED' GROUP BY route, CAST(date_trunc('month', flight_date) AS DATE))"""

OCC = "(100.0::DOUBLE * passengers / capacity)"
W7 = "(PARTITION BY route ORDER BY flight_date, id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


AMOUNT = """CASE WHEN isfinite(TRY_CAST(amount AS DOUBLE)) AND abs(TRY_CAST(amount AS DOUBLE)) < 1e18
              THEN TRY_CAST(amount AS DOUBLE) END"""


def _silver_orders_cte(source: str = "bronze_orders", name: str = "silver_orders",
                       mode: str = "filter", seq: str = "") -> str:
    """Latest row per order by commit order (``seq``, where there is one), time, op, all else."""
    where, last = ("op <> 'D'", "") if mode == "filter" else ("op IS NOT NULL", " AND op <> 'D'")
    pick = f"""SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {seq + ' DESC,' if seq else ''}
          TRY_CAST(updated_at AS TIMESTAMP) DESC NULLS LAST,
          CASE op WHEN 'I' THEN 0 WHEN 'U' THEN 1 WHEN 'D' THEN 2 ELSE -1 END DESC,
          customer_id DESC NULLS LAST, product DESC NULLS LAST, quantity DESC NULLS LAST,
          amount DESC NULLS LAST, status DESC NULLS LAST, created_at DESC NULLS LAST,
          updated_at DESC NULLS LAST, op DESC NULLS LAST) AS rn
      FROM {source} WHERE {where}) WHERE rn = 1{last}"""
    return f"""{name} AS (
  SELECT order_id, TRY_CAST(customer_id AS INTEGER) AS customer_id, product,
         TRY_CAST(quantity AS INTEGER) AS quantity, {AMOUNT} AS amount,
         trim(upper(status)) AS status, TRY_CAST(created_at AS TIMESTAMP) AS created_at,
         TRY_CAST(updated_at AS TIMESTAMP) AS updated_at,
         CAST(year(TRY_CAST(created_at AS TIMESTAMP)) AS INTEGER) AS year,
         CAST(month(TRY_CAST(created_at AS TIMESTAMP)) AS INTEGER) AS month
  FROM ({pick}) d)"""


SILVER_ORDERS = _silver_orders_cte()

SILVER_CUSTOMERS = """silver_customers AS (
  SELECT TRY_CAST(customer_id AS INTEGER) AS customer_id, name, email,
         trim(upper(country)) AS country, TRY_CAST(created_at AS TIMESTAMP) AS created_at
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY
            CASE op WHEN 'I' THEN 0 WHEN 'U' THEN 1 WHEN 'D' THEN 2 ELSE -1 END DESC,
            name DESC NULLS LAST, email DESC NULLS LAST, country DESC NULLS LAST,
            created_at DESC NULLS LAST, op DESC NULLS LAST) AS rn
        FROM bronze_customers WHERE op <> 'D') d WHERE rn = 1)"""

SUM_AMT = "CAST(SUM(CAST(amount AS DECIMAL(38,9))) AS DOUBLE)"

ORACLE: dict[str, str] = {}

# -- flights family ---------------------------------------------------------
ORACLE["cancellations_rank"] = with_(FLIGHTS, MONTHLY_CANCEL) + f"""
SELECT {ym('month')} AS month, route, cancellations, ranking FROM (
  SELECT *, CAST(rank() OVER (PARTITION BY month ORDER BY cancellations DESC) AS BIGINT) AS ranking
  FROM monthly) WHERE ranking <= 3"""

ORACLE["rank_variants"] = with_(FLIGHTS, MONTHLY_CANCEL) + f"""
SELECT {ym('month')} AS month, route, cancellations,
  CAST(rank() OVER (PARTITION BY month ORDER BY cancellations DESC) AS BIGINT) AS rank,
  CAST(dense_rank() OVER (PARTITION BY month ORDER BY cancellations DESC) AS BIGINT) AS dense_rank,
  CAST(row_number() OVER (PARTITION BY month ORDER BY cancellations DESC, route) AS BIGINT) AS row_num
FROM monthly"""

ORACLE["sliding_occupancy"] = with_(FLIGHTS) + f"""
SELECT route, flight_date, id, passengers, capacity, {rnd(OCC, 2)} AS occupancy_pct,
       {rnd(f'AVG({OCC}) OVER {W7}', 2)} AS occupancy_avg_7,
       COUNT(*) OVER {W7} AS rows_in_window
FROM flights WHERE status <> 'CANCELLED'"""

ORACLE["sliding_stats"] = with_(FLIGHTS) + f"""
SELECT route, flight_date, id, {rnd(OCC, 2)} AS occupancy_pct,
       {rnd(f'AVG({OCC}) OVER w', 2)} AS avg_7, {rnd(f'MIN({OCC}) OVER w', 2)} AS min_7,
       {rnd(f'MAX({OCC}) OVER w', 2)} AS max_7
FROM flights WHERE status <> 'CANCELLED'
WINDOW w AS {W7}"""

ORACLE["range_occupancy"] = with_(FLIGHTS) + f"""
SELECT route, flight_date, id,
  {rnd(f"AVG({OCC}) OVER (PARTITION BY route ORDER BY flight_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)", 2)} AS occupancy_avg_7d,
  COUNT(*) OVER (PARTITION BY route ORDER BY flight_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS rows_in_range
FROM flights WHERE status <> 'CANCELLED'"""

_LEAD = """led AS (
  SELECT event_id, ts, system,
         LEAD(ts) OVER (ORDER BY ts, event_id) AS next_ts,
         LEAD(event_id) OVER (ORDER BY ts, event_id) AS next_event_id
  FROM system_log)"""
_US = "(epoch_us(next_ts) - epoch_us(ts))"

ORACLE["gap_detection"] = with_(SYSTEM_LOG, _LEAD) + f"""
SELECT ts AS gap_start, next_ts AS gap_end, system, {_US} / 60000000.0 AS minutes_idle
FROM led WHERE next_ts - ts > INTERVAL 30 MINUTES"""

ORACLE["gap_report"] = with_(SYSTEM_LOG, _LEAD) + f"""
SELECT event_id AS event_start, next_event_id AS event_end, system,
       strftime(ts, '%H:%M:%S') AS start_time, strftime(next_ts, '%H:%M:%S') AS end_time,
       {rnd(f'{_US} / 60000000.0', 1)} AS minutes_idle
FROM led WHERE next_ts - ts > INTERVAL 30 MINUTES"""

ORACLE["gap_summary"] = with_(SYSTEM_LOG, _LEAD) + f"""
SELECT COUNT(*) AS total_gaps, {rnd(f'MAX({_US}) / 60000000.0', 1)} AS longest_gap_min,
       {rnd(f'SUM({_US}) / 60000000.0', 1)} AS total_idle_min
FROM led WHERE next_ts - ts > INTERVAL 30 MINUTES"""

_MOM = """lagged AS (
  SELECT route, month, cancellations,
         LAG(cancellations) OVER (PARTITION BY route ORDER BY month) AS prev_cancellations
  FROM monthly)"""
ORACLE["mom_change"] = with_(FLIGHTS, MONTHLY_CANCEL, _MOM) + f"""
SELECT route, {ym('month')} AS month, cancellations, prev_cancellations,
  CASE WHEN prev_cancellations IS NULL THEN NULL
       ELSE {rnd('100.0::DOUBLE * (cancellations - prev_cancellations) / NULLIF(prev_cancellations, 0)', 1)} END AS variation_pct,
  CASE WHEN cancellations > COALESCE(prev_cancellations, 0) THEN 'PEOR'
       WHEN cancellations < prev_cancellations THEN 'MEJOR' ELSE 'IGUAL' END AS trend
FROM lagged"""

ORACLE["worsened_over_20"] = with_(FLIGHTS, MONTHLY_CANCEL, _MOM) + f"""
SELECT * FROM (
  SELECT route, {ym('month')} AS month, cancellations, prev_cancellations,
    {rnd('100.0::DOUBLE * (cancellations - prev_cancellations) / NULLIF(prev_cancellations, 0)', 1)} AS variation_pct
  FROM lagged) WHERE variation_pct > 20"""

ORACLE["mom_change_calendar"] = with_(FLIGHTS, MONTHLY_CANCEL, """span AS (
  SELECT route, min(month) AS lo, max(month) AS hi FROM monthly GROUP BY route)""", """dense AS (
  SELECT g.route, CAST(g.month AS DATE) AS month, COALESCE(m.cancellations, 0) AS cancellations
  FROM (SELECT route, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS month FROM span) g
  LEFT JOIN monthly m ON m.route = g.route AND m.month = CAST(g.month AS DATE))""", """lagged AS (
  SELECT route, month, cancellations,
         LAG(cancellations) OVER (PARTITION BY route ORDER BY month) AS prev_cancellations
  FROM dense)""") + f"""
SELECT route, {ym('month')} AS month, cancellations, prev_cancellations,
  CASE WHEN prev_cancellations IS NULL THEN NULL
       ELSE {rnd('100.0::DOUBLE * (cancellations - prev_cancellations) / NULLIF(prev_cancellations, 0)', 1)} END AS variation_pct,
  CASE WHEN cancellations > COALESCE(prev_cancellations, 0) THEN 'PEOR'
       WHEN cancellations < prev_cancellations THEN 'MEJOR' ELSE 'IGUAL' END AS trend
FROM lagged"""

ORACLE["lag_default"] = with_(FLIGHTS, MONTHLY_CANCEL) + f"""
SELECT route, {ym('month')} AS month, cancellations,
       CAST(LAG(cancellations, 1, 0) OVER (PARTITION BY route ORDER BY month) AS BIGINT) AS prev_or_default
FROM monthly"""

ORACLE["running_total"] = with_(FLIGHTS) + f"""
SELECT route, flight_date, id, passengers,
  CAST(SUM(passengers) OVER (PARTITION BY route ORDER BY flight_date) AS BIGINT) AS running_passengers,
  CAST(SUM(passengers) OVER (PARTITION BY route) AS BIGINT) AS total_month,
  {rnd('100.0::DOUBLE * SUM(passengers) OVER (PARTITION BY route ORDER BY flight_date) / SUM(passengers) OVER (PARTITION BY route)', 1)} AS pct_of_total
FROM flights
WHERE status <> 'CANCELLED' AND date_trunc('month', flight_date) = DATE '1996-01-01'"""

ORACLE["running_count"] = with_(FLIGHTS) + """
SELECT flight_date, route, status, id,
  COUNT(*) OVER (PARTITION BY route, status ORDER BY flight_date, id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count
FROM flights
WHERE flight_date BETWEEN DATE '1996-01-01' AND DATE '1996-01-31' AND route = '1-URGENT'"""

ORACLE["calendar_activity"] = with_(FLIGHTS) + """
SELECT CAST(s.day AS DATE) AS day, COUNT(v.id) AS flights_of_day,
       CAST(COALESCE(SUM(v.passengers), 0) AS BIGINT) AS passengers_of_day,
       CASE WHEN COUNT(v.id) = 0 THEN 'SIN OPERACION' ELSE 'OPERATIVO' END AS day_status
FROM (SELECT unnest(generate_series(DATE '1996-01-01', DATE '1996-01-31', INTERVAL 1 DAY)) AS day) s
LEFT JOIN flights v ON v.flight_date = CAST(s.day AS DATE) AND v.route = '1-URGENT'
     AND v.status <> 'CANCELLED'
GROUP BY s.day"""

ORACLE["date_series"] = with_(FLIGHTS) + """
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
FROM (SELECT min(flight_date) AS lo, max(flight_date) AS hi FROM flights)"""

_CELLS = "coalesce(order_id, ''), coalesce(customer_id, ''), {} coalesce(product, ''), coalesce(quantity, ''), coalesce(amount, ''), coalesce(status, ''), coalesce(created_at, '')"
_MORE = ", coalesce(updated_at, ''), coalesce(op, '')"
_PLAIN = _CELLS.format("")
_OPENED = _CELLS.replace("{} coalesce(product, '')", "concat('\"', coalesce(product, ''))")
ORACLE["generated_ids"] = with_(BRONZE_ORDERS) + """
SELECT order_id, op, sha256(concat_ws(chr(1), order_id, op, created_at)) AS generated_id FROM bronze_orders"""
ORACLE["csv_quarantine"] = with_(BRONZE_ORDERS, f"""lines AS (
  SELECT CASE CAST(order_id AS BIGINT) % 53 WHEN 4 THEN concat_ws(',', {_PLAIN})
              WHEN 5 THEN concat_ws(',', {_PLAIN}{_MORE}, 'extra') WHEN 6 THEN concat_ws(',', {_OPENED}{_MORE}) END AS line
  FROM bronze_orders)""") + "SELECT line, count(*) AS row_count FROM lines GROUP BY line"

ORACLE["recursive_date_series"] = "WITH RECURSIVE " + FLIGHTS + """,
span AS (SELECT route, min(flight_date) AS lo, max(flight_date) AS hi FROM flights GROUP BY route),
series AS (
  SELECT route, lo AS day, hi FROM span
  UNION ALL
  SELECT route, CAST(day + 1 AS DATE), hi FROM series WHERE day < hi)
SELECT route, day FROM series"""

ORACLE["anchored_date_series"] = ORACLE["date_series_steps"] = ORACLE["recursive_date_series"]

ORACLE["cross_join_grid"] = with_(FLIGHTS) + """
SELECT g.route, g.day, COALESCE(d.n, 0) AS flights, CAST(COALESCE(d.p, 0) AS BIGINT) AS passengers
FROM (SELECT r.route, CAST(s.day AS DATE) AS day
      FROM (SELECT DISTINCT route FROM flights) r
      CROSS JOIN (SELECT unnest(generate_series(min(flight_date), max(flight_date), INTERVAL 1 DAY)) AS day
                  FROM flights) s) g
LEFT JOIN (SELECT route, flight_date AS day, COUNT(*) AS n, SUM(passengers) AS p
           FROM flights GROUP BY route, flight_date) d
  ON d.route = g.route AND d.day = g.day"""

ORACLE["latest_per_group"] = with_(FLIGHTS) + f"""
SELECT route, {ym('flight_date')} AS month, flight_date AS last_flight, status, passengers FROM (
  SELECT *, row_number() OVER (PARTITION BY route, date_trunc('month', flight_date)
                               ORDER BY flight_date DESC, id DESC) AS rn
  FROM flights) WHERE rn = 1"""

ORACLE["first_last_cancellation"] = with_(FLIGHTS) + """
SELECT route, min(flight_date) AS first_cancellation, max(flight_date) AS last_cancellation
FROM flights WHERE status = 'CANCELLED' GROUP BY route"""

ORACLE["distinct_on"] = with_(FLIGHTS) + """
SELECT DISTINCT ON (route) route, flight_date AS last_flight, status, passengers
FROM flights ORDER BY route, flight_date DESC, id DESC"""

_WFULL = ("(PARTITION BY route, date_trunc('month', flight_date) ORDER BY flight_date, id "
          "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
ORACLE["first_last_baseline"] = with_(FLIGHTS) + f"""
SELECT route, flight_date, id, {rnd(OCC, 2)} AS occupancy_pct,
  {rnd(f'FIRST_VALUE({OCC}) OVER {_WFULL}', 2)} AS first_flight_pct,
  {rnd(f'LAST_VALUE({OCC}) OVER {_WFULL}', 2)} AS last_flight_pct,
  {rnd(f'{OCC} - FIRST_VALUE({OCC}) OVER {_WFULL}', 2)} AS diff_vs_first
FROM flights
WHERE status <> 'CANCELLED' AND route = '1-URGENT' AND date_trunc('month', flight_date) = DATE '1996-01-01'"""

ORACLE["nth_value_baseline"] = with_(FLIGHTS) + f"""
SELECT route, flight_date, id, {rnd(OCC, 2)} AS occupancy_pct,
  {rnd(f'NTH_VALUE({OCC}, 3) OVER {_WFULL}', 2)} AS nth_flight_pct
FROM flights
WHERE status <> 'CANCELLED' AND date_trunc('month', flight_date) = DATE '1996-02-01'"""

ORACLE["ntile_labels"] = with_(FLIGHTS) + f"""
SELECT route, flight_date, id, passengers, {rnd(OCC, 2)} AS occupancy_pct,
  CAST(NTILE(4) OVER (ORDER BY passengers DESC NULLS FIRST, flight_date, id) AS BIGINT) AS quartile,
  CASE NTILE(4) OVER (ORDER BY passengers DESC NULLS FIRST, flight_date, id)
       WHEN 1 THEN 'LLENO' WHEN 2 THEN 'ALTO' WHEN 3 THEN 'MEDIO' WHEN 4 THEN 'BAJO' END AS category
FROM flights
WHERE status <> 'CANCELLED' AND date_trunc('month', flight_date) = DATE '1996-01-01'"""

ORACLE["fully_cancelled_days"] = with_(FLIGHTS, """days AS (
  SELECT route, count(*) FILTER (WHERE status = 'CANCELLED') AS off,
         count(*) FILTER (WHERE status <> 'CANCELLED') AS flown
  FROM flights GROUP BY route, flight_date)""") + """
SELECT route FROM days WHERE off > 0 AND flown = 0 GROUP BY route"""

ORACLE["lookback_count_7d"] = with_(FLIGHTS) + """
SELECT f.route, f.flight_date, f.status, f.id, count(c.id) AS cancellations_7d
FROM flights f LEFT JOIN flights c
  ON c.route = f.route AND c.status = 'CANCELLED' AND f.flight_date - c.flight_date BETWEEN 1 AND 7
WHERE f.route = '1-URGENT' AND f.flight_date BETWEEN DATE '1996-01-08' AND DATE '1996-01-31'
GROUP BY f.route, f.flight_date, f.status, f.id"""

ORACLE["band_count_36h"] = with_(SYSTEM_LOG) + """
SELECT e.event_id, e.user_id, e.ts, count(w.event_id) AS warnings_before
FROM (SELECT * FROM system_log WHERE severity = 'ERROR') e LEFT JOIN (SELECT * FROM system_log WHERE severity = 'WARN') w
  ON w.user_id = e.user_id AND w.ts >= e.ts - INTERVAL 36 HOUR AND w.ts < e.ts
GROUP BY e.event_id, e.user_id, e.ts"""

ORACLE["band_range_36h"] = with_(SYSTEM_LOG) + """
SELECT event_id, system, count(*) OVER w AS events_in_range, CAST(sum(user_id) OVER w AS BIGINT) AS user_id_sum
FROM system_log WINDOW w AS (PARTITION BY system ORDER BY ts RANGE BETWEEN INTERVAL 36 HOUR PRECEDING AND CURRENT ROW)"""

ORACLE["band_pairs_36h"] = with_(SYSTEM_LOG) + """
SELECT e.user_id, e.event_id, w.event_id AS warning_id,
       CAST(floor((epoch_us(e.ts) - epoch_us(w.ts)) / 60000000.0) AS BIGINT) AS minutes_between
FROM system_log e JOIN system_log w ON w.user_id = e.user_id AND w.ts >= e.ts - INTERVAL 36 HOUR AND w.ts < e.ts
WHERE e.severity = 'ERROR' AND w.severity = 'WARN'"""

ORACLE["above_average_rate"] = with_(FLIGHTS, """per AS (
  SELECT route, count(*) AS total_flights, sum(CASE WHEN status = 'CANCELLED' THEN 1 ELSE 0 END) AS cancelled
  FROM flights GROUP BY route)""") + f"""
SELECT route, total_flights, CAST(cancelled AS BIGINT) AS cancelled, {rnd('100.0::DOUBLE * cancelled / total_flights', 2)} AS cancellation_rate_pct
FROM (SELECT *, sum(cancelled) OVER () AS all_cancelled, sum(total_flights) OVER () AS all_flights FROM per)
WHERE cancelled * all_flights > all_cancelled * total_flights"""

ORACLE["never_completed"] = with_(FLIGHTS, """february AS (
  SELECT carrier, status FROM flights WHERE flight_date >= DATE '1996-02-01' AND flight_date < DATE '1996-03-01')""") + """
SELECT carrier FROM february EXCEPT SELECT carrier FROM february WHERE status = 'COMPLETED'"""

ORACLE["join_on_expression"] = with_(FLIGHTS) + """
SELECT v.id, v.route, v.carrier, t.c_name, t.c_mktsegment AS role
FROM flights v JOIN customer t ON t.c_name = printf('Customer#%09d', v.carrier)
WHERE t.c_mktsegment IN ('BUILDING', 'MACHINERY')"""

ORACLE["inline_values"] = with_(FLIGHTS) + """
SELECT c.status, v.status_es, c.flights
FROM (SELECT status, COUNT(*) AS flights FROM flights GROUP BY status) c
LEFT JOIN (VALUES ('COMPLETED', 'COMPLETADO'), ('CANCELLED', 'CANCELADO'), ('DELAYED', 'DEMORADO'))
     AS v(status, status_es) ON v.status = c.status"""

ORACLE["filter_between"] = with_(FLIGHTS) + """
SELECT id, route, flight_date, status FROM flights
WHERE flight_date BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'"""

ORACLE["filter_in"] = with_(FLIGHTS) + """
SELECT id, route, flight_date, status, CAST(dayofweek(flight_date) AS INTEGER) AS dow FROM flights
WHERE status IN ('CANCELLED', 'DELAYED') AND dayofweek(flight_date) IN (5, 6)"""

ORACLE["filter_month"] = with_(FLIGHTS) + """
SELECT id, route, flight_date, status FROM flights
WHERE date_trunc('month', flight_date) = DATE '1996-02-01'"""

ORACLE["filter_not_equal"] = with_(BRONZE_ORDERS) + """
SELECT order_id, op FROM bronze_orders WHERE op <> 'D'"""

# -- medallion --------------------------------------------------------------
ORACLE["silver_orders"] = with_(BRONZE_ORDERS, SILVER_ORDERS) + "SELECT * FROM silver_orders"
ORACLE["silver_customers"] = with_(BRONZE_CUSTOMERS, SILVER_CUSTOMERS) + "SELECT * FROM silver_customers"

GOLD: dict[str, str] = {}
GOLD["daily_sales"] = f"""
SELECT CAST(created_at AS DATE) AS date, COUNT(order_id) AS total_orders,
       {rnd(SUM_AMT, 2)} AS total_revenue,
       {rnd(f'{SUM_AMT} / COUNT(amount)', 2)} AS avg_order_value,
       COUNT(DISTINCT customer_id) AS unique_customers
FROM silver_orders GROUP BY CAST(created_at AS DATE)"""

GOLD["product_ranking"] = f"""
SELECT *, CAST(dense_rank() OVER (ORDER BY total_revenue DESC) AS BIGINT) AS revenue_rank FROM (
  SELECT product, COUNT(order_id) AS total_orders, CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
         {rnd(SUM_AMT, 2)} AS total_revenue,
         {rnd(f'{SUM_AMT} / COUNT(amount)', 2)} AS avg_unit_price,
         {rnd(f'{SUM_AMT} / SUM(quantity)', 2)} AS true_unit_price
  FROM silver_orders GROUP BY product)"""

GOLD["customer_summary"] = f"""
SELECT a.customer_id, a.total_orders, a.total_spent, a.avg_order_value, a.last_order_date,
       c.name, c.email, c.country, t.top_product
FROM (SELECT customer_id, COUNT(order_id) AS total_orders, {rnd(SUM_AMT, 2)} AS total_spent,
             {rnd(f'{SUM_AMT} / COUNT(amount)', 2)} AS avg_order_value,
             MAX(created_at) AS last_order_date
      FROM silver_orders GROUP BY customer_id) a
LEFT JOIN silver_customers c ON c.customer_id = a.customer_id
LEFT JOIN (SELECT customer_id, product AS top_product FROM (
             SELECT customer_id, product,
                    rank() OVER (PARTITION BY customer_id ORDER BY COUNT(order_id) DESC) AS r
             FROM silver_orders GROUP BY customer_id, product) WHERE r = 1) t
  ON t.customer_id = a.customer_id"""

for _name, _gold in GOLD.items():
    ORACLE[_name] = with_(BRONZE_ORDERS, SILVER_ORDERS, BRONZE_CUSTOMERS, SILVER_CUSTOMERS) + _gold

ORACLE["silver_status_rollup"] = with_(BRONZE_ORDERS, SILVER_ORDERS) + """
SELECT status, COUNT(*) AS total,
       CAST(ROUND(SUM(CAST(amount AS DECIMAL(38,9))), 2) AS DOUBLE) AS revenue
FROM silver_orders GROUP BY status"""

# -- change capture -----------------------------------------------------------
FEED = """feed AS (
  SELECT *, 0 AS commit_seq FROM bronze_orders
  UNION ALL SELECT *, 1 AS commit_seq FROM order_changes
  UNION ALL SELECT *, 2 AS commit_seq FROM order_reinserts)"""
FEED_CTES = (BRONZE_ORDERS, ORDER_CHANGES, ORDER_REINSERTS, FEED)
STATE = _silver_orders_cte("feed", "state", mode="apply", seq="commit_seq")

ORACLE["cdc_full_load"] = "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, CAST(1 + (SELECT COUNT(*) FROM (DESCRIBE {t})) AS INTEGER) AS columns,
       COUNT(*) AS row_count FROM {t}""" for t in TABLES)
ORACLE["cdc_snapshot_plus_changes"] = with_(*FEED_CTES) + \
    "SELECT order_id, op, amount, updated_at, commit_seq FROM feed"
ORACLE["cdc_inserts_updates"] = with_(*FEED_CTES) + \
    "SELECT order_id, op, amount, updated_at, commit_seq FROM feed WHERE op IN ('I', 'U')"
ORACLE["cdc_current_state"] = with_(*FEED_CTES, STATE) + "SELECT * FROM state"
ORACLE["cdc_current_state_filter"] = with_(
    *FEED_CTES, _silver_orders_cte("feed", "state", mode="filter", seq="commit_seq")) + "SELECT * FROM state"

ORACLE["dedup_by_key"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
        l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
        l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
        l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
      FROM lineitem) WHERE rn = 1"""

# -- events ---------------------------------------------------------------------
GOOD_EVENTS = """good AS (
  SELECT event_id AS seq, order_id AS partition_key, md5(CAST(event_id AS VARCHAR)) AS event_id, order_id,
         CAST(customer_id AS VARCHAR) AS customer_id, event_type, COALESCE(product, '') AS product,
         COALESCE(amount, '0') AS amount, status, timestamp
  FROM order_events WHERE NOT is_corrupt AND NOT misses_order_id)"""
ITEMS = """items AS (
  SELECT seq, concat('ORDER#', order_id) AS pk, concat('EVENT#', timestamp, '#', event_type) AS sk,
         concat('CUSTOMER#', customer_id) AS gsi1pk, timestamp AS gsi1sk,
         event_id, order_id, customer_id, event_type, product, amount, status, timestamp
  FROM good)"""

ORACLE["event_decode"] = with_(ORDER_EVENTS, GOOD_EVENTS) + "SELECT * FROM good"
ORACLE["event_dead_letter"] = with_(ORDER_EVENTS) + """
SELECT event_id AS seq, order_id AS partition_key,
       CASE WHEN is_corrupt THEN 'undecodable_payload' ELSE 'missing_order_id' END AS reason
FROM order_events WHERE is_corrupt OR misses_order_id"""
ORACLE["event_batch_counters"] = with_(ORDER_EVENTS) + """
SELECT COUNT(*) FILTER (WHERE NOT (is_corrupt OR misses_order_id)) AS processed,
       COUNT(*) FILTER (WHERE is_corrupt OR misses_order_id) AS failed
FROM order_events"""
ITEM_COLS = "pk, sk, gsi1pk, gsi1sk, event_id, order_id, customer_id, event_type, product, amount, status, timestamp"
ORACLE["event_items"] = with_(ORDER_EVENTS, GOOD_EVENTS, ITEMS) + f"SELECT {ITEM_COLS} FROM items"
ORACLE["event_upsert"] = with_(ORDER_EVENTS, GOOD_EVENTS, ITEMS) + """
SELECT * EXCLUDE (seq) REPLACE (CASE WHEN seq % 3 = 0 THEN CASE WHEN seq % 6 = 0 THEN amount ELSE '777' END ELSE amount END AS amount,
                                CASE WHEN seq % 6 = 0 THEN 'resent' ELSE status END AS status)
FROM items"""
ORACLE["order_history"] = with_(ORDER_EVENTS, GOOD_EVENTS, ITEMS) + """
SELECT pk, sk, event_type, status, timestamp, row_number() OVER (PARTITION BY pk ORDER BY sk) AS position FROM items"""
ORACLE["order_history_of"] = with_(ORDER_EVENTS, GOOD_EVENTS, ITEMS) + f"""
SELECT {ITEM_COLS}, row_number() OVER (ORDER BY sk) AS position FROM items WHERE order_id = 'o7'"""
ORACLE["order_history_range"] = with_(ORDER_EVENTS, GOOD_EVENTS, ITEMS) + """
SELECT pk, sk, event_type FROM items WHERE sk >= 'EVENT#2024-01-10' AND sk < 'EVENT#2024-01-20'"""
ORACLE["customer_orders"] = with_(ORDER_EVENTS, GOOD_EVENTS, ITEMS) + f"""
SELECT {ITEM_COLS}, row_number() OVER (PARTITION BY gsi1pk ORDER BY gsi1sk, pk, sk) AS position FROM items"""
ORACLE["order_current_state"] = with_(ORDER_EVENTS, GOOD_EVENTS, ITEMS) + """
SELECT order_id, event_type, status, timestamp AS last_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY sk DESC) AS rn FROM items) WHERE rn = 1"""
_PREV = """prev AS (
  SELECT order_id, event_type, timestamp,
         LAG(event_type) OVER (PARTITION BY order_id ORDER BY sk) AS prev_event_type,
         LAG(timestamp) OVER (PARTITION BY order_id ORDER BY sk) AS prev_timestamp
  FROM items)"""
ORACLE["lifecycle_violations"] = with_(ORDER_EVENTS, GOOD_EVENTS, ITEMS, _PREV) + """
SELECT order_id, prev_event_type, event_type, timestamp FROM prev
WHERE NOT ((prev_event_type IS NULL AND event_type = 'order_placed')
        OR (prev_event_type = 'order_placed' AND event_type = 'order_confirmed')
        OR (prev_event_type = 'order_confirmed' AND event_type = 'order_shipped')
        OR (prev_event_type = 'order_shipped' AND event_type = 'order_delivered')
        OR (prev_event_type = 'order_confirmed' AND event_type = 'order_cancelled'))"""
_ISO = "CAST(replace(left({c}, 23), 'T', ' ') AS TIMESTAMP)"
ORACLE["lifecycle_durations"] = with_(ORDER_EVENTS, GOOD_EVENTS, ITEMS, _PREV) + f"""
SELECT order_id, event_type, prev_event_type,
       (epoch_us({_ISO.format(c='timestamp')}) - epoch_us({_ISO.format(c='prev_timestamp')})) / 1000000.0
         AS seconds_since_prev
FROM prev"""

ORACLE["processed_stamp"] = with_(BRONZE_ORDERS, SILVER_ORDERS) + """
SELECT count(*) AS row_count, CAST(1 AS BIGINT) AS stamps, true AS in_run FROM silver_orders"""
ORACLE["stream_batch_counters"] = with_(ORDER_EVENTS) + """
SELECT CAST(event_id % 3 AS INTEGER) AS batch_id, COUNT(*) FILTER (WHERE NOT (is_corrupt OR misses_order_id)) AS processed,
       COUNT(*) FILTER (WHERE is_corrupt OR misses_order_id) AS failed,
       nullif(COUNT(*) FILTER (WHERE is_corrupt OR misses_order_id), 0) AS dead_letters
FROM order_events GROUP BY event_id % 3"""
_STEP = "SELECT order_id, CAST(replace(left(timestamp, 23), 'T', ' ') AS TIMESTAMP) AS tm FROM good WHERE event_type = '{}'"
ORACLE["stream_step_waits"] = with_(
    ORDER_EVENTS, GOOD_EVENTS, f"placed AS ({_STEP.format('order_placed')})", f"confirmed AS ({_STEP.format('order_confirmed')})",
    """mark AS (SELECT least((SELECT max(tm) FROM placed), (SELECT max(tm) FROM confirmed)) - INTERVAL 2 HOUR AS w)""") + """
SELECT p.order_id, p.tm AS step_at, c.tm AS next_at, (epoch_us(c.tm) - epoch_us(p.tm)) / 1000000.0 AS seconds
FROM placed p LEFT JOIN confirmed c ON c.order_id = p.order_id AND c.tm BETWEEN p.tm AND p.tm + INTERVAL 5 MINUTE
WHERE c.tm IS NOT NULL OR p.tm + INTERVAL 5 MINUTE < (SELECT w FROM mark)"""

# -- data quality -------------------------------------------------------------
def _nn(cols, table, key):
    parts = []
    for c in cols:
        parts.append(f"""SELECT 'not_null' AS rule, '{c}' AS column,
       COUNT(*) FILTER (WHERE {c} IS NULL) AS violations,
       CAST(MIN(CASE WHEN {c} IS NULL THEN CAST({key} AS VARCHAR) END) AS VARCHAR) AS sample_key
FROM {table}""")
    return "\nUNION ALL\n".join(parts)


_BRONZE_ORDER_COLS = ["order_id", "customer_id", "product", "quantity", "amount", "status",
                      "created_at", "updated_at", "op"]
ORACLE["dq_not_null"] = with_(BRONZE_ORDERS) + _nn(_BRONZE_ORDER_COLS, "bronze_orders", "order_id")


def _acc(col, values, table, key):
    vals = ", ".join(f"'{v}'" for v in values)
    bad = f"({col} IS NOT NULL AND {col} NOT IN ({vals}))"
    return f"""SELECT 'accepted_values' AS rule, '{col}' AS column, COUNT(*) FILTER (WHERE {bad}) AS violations,
       MIN(CASE WHEN {bad} THEN CAST({key} AS VARCHAR) END) AS sample_key FROM {table}"""


ORACLE["dq_accepted_values"] = with_(BRONZE_ORDERS, ORDER_EVENTS) + "\nUNION ALL\n".join([
    _acc("op", ["I", "U", "D"], "bronze_orders", "order_id"),
    _acc("product", ["1-URGENT", "2-HIGH", "3-MEDIUM"], "bronze_orders", "order_id"),
    _acc("event_type", ["order_placed", "order_confirmed", "order_shipped", "order_delivered"],
         "order_events", "event_id")])


def _uniq(keys, table):
    kt = " || ',' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"""SELECT 'unique' AS rule, '{','.join(keys)}' AS column, COUNT(*) AS violations, MIN(k) AS sample_key
FROM (SELECT {kt} AS k FROM {table} GROUP BY {', '.join(keys)} HAVING COUNT(*) > 1)"""


ORACLE["dq_unique"] = _uniq(["l_orderkey", "l_linenumber"], "lineitem") + "\nUNION ALL\n" + \
    _uniq(["o_orderkey"], "orders")


def _fk(table, fk, parent, pk):
    return f"""SELECT 'foreign_key' AS rule, '{fk}' AS column, COUNT(*) AS violations,
       MIN(CAST({fk} AS VARCHAR)) AS sample_key
FROM {table} c WHERE {fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})"""


ORACLE["dq_foreign_key"] = "\nUNION ALL\n".join([
    _fk("lineitem", "l_orderkey", "orders", "o_orderkey"),
    _fk("lineitem", "l_partkey", "part", "p_partkey"),
    _fk("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    _fk("orders", "o_custkey", "customer", "c_custkey")])

ORACLE["dq_defaults"] = with_(ORDER_EVENTS) + "\nUNION ALL\n".join(
    f"""SELECT 'default_applied' AS rule, '{c}' AS column, COUNT(*) FILTER (WHERE {c} IS NULL) AS violations,
       MIN(CASE WHEN {c} IS NULL THEN CAST(event_id AS VARCHAR) END) AS sample_key FROM order_events"""
    for c in ["product", "amount"])


def _bound(name, bad):
    return f"""SELECT 'bounds' AS rule, '{name}' AS column, COUNT(*) FILTER (WHERE {bad}) AS violations,
       MIN(CASE WHEN {bad} THEN order_id END) AS sample_key FROM bronze_orders"""


ORACLE["dq_bounds"] = with_(BRONZE_ORDERS) + "\nUNION ALL\n".join([
    _bound("product<= 10 chars", "length(product) > 10"),
    _bound("status<= 20 chars", "length(status) > 20"),
    _bound("amount fits decimal(10,2)", "amount IS NOT NULL AND TRY_CAST(amount AS DECIMAL(10,2)) IS NULL")])

# -- casts ----------------------------------------------------------------------
_TYPES = [("customer_id", "int", "INTEGER"), ("quantity", "int", "INTEGER"), ("amount", "double", "DOUBLE"),
          ("created_at", "timestamp_ntz", "TIMESTAMP"), ("updated_at", "timestamp_ntz", "TIMESTAMP")]
ORACLE["typed_cast"] = with_(BRONZE_ORDERS) + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column, '{st}' AS target_type,
       COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {dt}) IS NULL) AS rejected,
       COUNT(*) FILTER (WHERE TRY_CAST({c} AS {dt}) IS NOT NULL) AS accepted FROM bronze_orders"""
    for c, st, dt in _TYPES)
ORACLE["resolve_choice"] = with_(ORDER_EVENTS) + """
SELECT event_id, TRY_CAST(amount AS DOUBLE) AS amount, TRY_CAST(product AS DOUBLE) AS product_double,
       CASE WHEN TRY_CAST(product AS DOUBLE) IS NULL THEN product END AS product_text
FROM order_events"""
ORACLE["apply_mapping"] = with_(BRONZE_ORDERS) + """
SELECT TRY_CAST(order_id AS BIGINT) AS order_key, TRY_CAST(customer_id AS INTEGER) AS customer_key,
       TRY_CAST(amount AS DOUBLE) AS amount_value, TRY_CAST(created_at AS TIMESTAMP) AS created_ts
FROM bronze_orders"""

# -- scalar groups ------------------------------------------------------------
ORACLE["scalar_string"] = with_(BRONZE_CUSTOMERS) + """
SELECT customer_id, trim(upper(country)) AS country_norm, substring(name, 1, 3) AS name_prefix,
       concat('CUSTOMER#', customer_id) AS item_key, concat_ws('|', customer_id, email) AS joined
FROM bronze_customers"""
ORACLE["scalar_datetime"] = with_(SYSTEM_LOG) + """
SELECT event_id, strftime(ts, '%Y-%m') AS year_month, strftime(ts, '%H:%M:%S') AS clock,
       CAST(date_trunc('month', ts) AS DATE) AS month_start,
       CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month,
       CAST(year(ts) AS INTEGER) AS year, CAST(dayofweek(ts) AS INTEGER) AS dow,
       (epoch_us(ts) - epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP))) / 60000000.0 AS minutes_since_midnight,
       CAST(ts AS DATE) + 7 AS plus_7d, CAST(ts AS DATE) - 7 AS minus_7d,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso_ts
FROM system_log"""
ORACLE["scalar_numeric"] = f"""
SELECT o_orderkey, {rnd('o_totalprice / 7', 2)} AS price_div_7, o_orderkey % 7 AS key_mod_7,
       o_totalprice * 2 AS price_x2, o_custkey + 1 AS cust_plus_1,
       CAST(floor(o_totalprice / 1000) AS INTEGER) AS price_thousands, o_custkey / 3 AS cust_div_3
FROM orders"""
ORACLE["scalar_conditional"] = with_(ORDER_EVENTS) + """
SELECT event_id, status AS status_lookup, COALESCE(amount, '0') AS amount_or_zero,
       NULLIF(customer_id, 0) AS customer_or_null,
       CASE WHEN product IS NULL THEN 'missing' WHEN event_type = 'order_cancelled' THEN 'cancel'
            ELSE 'ok' END AS note
FROM order_events"""
ORACLE["scalar_json"] = with_(ORDER_EVENTS) + """
SELECT event_id AS seq,
       CASE WHEN is_corrupt THEN NULL ELSE md5(CAST(event_id AS VARCHAR)) END AS event_id,
       CASE WHEN is_corrupt THEN NULL ELSE event_type END AS event_type,
       CASE WHEN is_corrupt THEN NULL ELSE COALESCE(product, '') END AS product,
       CASE WHEN is_corrupt THEN NULL ELSE COALESCE(amount, '0') END AS amount,
       CASE WHEN is_corrupt THEN 'undecodable_payload' WHEN misses_order_id THEN 'missing_order_id' END AS reason
FROM order_events"""

ORACLE["table_counts"] = with_(FLIGHTS, SYSTEM_LOG, BRONZE_ORDERS, BRONZE_CUSTOMERS, ORDER_EVENTS) + """
SELECT 'flights' AS table_name, COUNT(*) AS row_count FROM flights UNION ALL
SELECT 'system_log', COUNT(*) FROM system_log UNION ALL
SELECT 'bronze_orders', COUNT(*) FROM bronze_orders UNION ALL
SELECT 'bronze_customers', COUNT(*) FROM bronze_customers UNION ALL
SELECT 'order_events', COUNT(*) FROM order_events"""

# -- sinks, catalog, incremental, streams ------------------------------------
ORACLE["csv_bronze_scan"] = with_(BRONZE_ORDERS) + "SELECT * FROM bronze_orders"
ORACLE["csv_recursive_scan"] = with_(BRONZE_ORDERS, ORDER_CHANGES) + \
    "SELECT * FROM bronze_orders UNION ALL SELECT * FROM order_changes"
ORACLE["parquet_scan"] = with_(FLIGHTS) + """
SELECT *, CAST(year(flight_date) AS INTEGER) AS year, CAST(month(flight_date) AS INTEGER) AS month
FROM flights"""
ORACLE["parquet_roundtrip"] = ORACLE["daily_sales"]
ORACLE["partitioned_sink_roundtrip"] = ORACLE["silver_orders"]
_CHANGES_SILVER = _silver_orders_cte("order_changes", "changes_silver", mode="filter")
ORACLE["append_sink"] = with_(BRONZE_ORDERS, SILVER_ORDERS, ORDER_CHANGES, _CHANGES_SILVER) + \
    "SELECT * FROM silver_orders UNION ALL SELECT * FROM changes_silver"
ORACLE["incremental_bookmark"] = ORACLE["append_sink"]
ORACLE["cdc_date_partitioned_sink"] = with_(*FEED_CTES) + """
SELECT order_id, op, amount, updated_at, commit_seq,
       strftime(TRY_CAST(updated_at AS TIMESTAMP), '%Y') AS year,
       strftime(TRY_CAST(updated_at AS TIMESTAMP), '%m') AS month,
       strftime(TRY_CAST(updated_at AS TIMESTAMP), '%d') AS day
FROM feed"""
ORACLE["write_metrics"] = with_(BRONZE_ORDERS, SILVER_ORDERS) + \
    "SELECT 'silver_orders' AS table_name, COUNT(*) AS rows_written FROM silver_orders"
ORACLE["insert_select"] = ORACLE["mom_change"]
ORACLE["table_lifecycle"] = ORACLE["join_on_expression"]
ORACLE["catalog_discover"] = with_(BRONZE_ORDERS, SILVER_ORDERS, ORDER_CHANGES, _CHANGES_SILVER) + """
SELECT status, channel, COUNT(*) AS total, CAST(ROUND(SUM(CAST(amount AS DECIMAL(38,9))), 2) AS DOUBLE) AS revenue
FROM (SELECT *, NULL AS channel FROM silver_orders UNION ALL SELECT *, 'web' AS channel FROM changes_silver)
GROUP BY status, channel"""
ORACLE["catalog_crawl"] = ORACLE["catalog_discover"]
ORACLE["incremental_empty_run"] = with_(BRONZE_ORDERS, SILVER_ORDERS, ORDER_CHANGES, _CHANGES_SILVER) + """
SELECT CAST(1 AS BIGINT) AS run, (SELECT COUNT(*) FROM silver_orders) AS rows_written UNION ALL
SELECT 2, (SELECT COUNT(*) FROM changes_silver) UNION ALL
SELECT 3, 0"""
ORACLE["incremental_merge"] = ORACLE["incremental_merge_pruned"] = ORACLE["cdc_current_state"]
ORACLE["incremental_customers"] = with_(BRONZE_CUSTOMERS, """customer_changes AS (
  SELECT * REPLACE (concat('new.', email) AS email, CASE CAST(customer_id AS BIGINT) % 20 WHEN 0 THEN 'U' ELSE 'D' END AS op)
  FROM bronze_customers WHERE CAST(customer_id AS BIGINT) % 20 <= 1)""") + """
SELECT CAST(customer_id AS INTEGER) AS customer_id, name, email, trim(upper(country)) AS country,
       CAST(created_at AS TIMESTAMP) AS created_at
FROM (SELECT * FROM customer_changes
      UNION ALL SELECT * FROM bronze_customers WHERE CAST(customer_id AS BIGINT) % 20 > 1)
WHERE op <> 'D'"""
ORACLE["stream_ingest"] = ORACLE["event_items"]
ORACLE["raw_hourly_landing"] = with_(ORDER_EVENTS, GOOD_EVENTS, ITEMS) + f"""
SELECT {ITEM_COLS}, substring(timestamp, 1, 4) AS year, substring(timestamp, 6, 2) AS month,
       substring(timestamp, 9, 2) AS day, substring(timestamp, 12, 2) AS hour
FROM items"""
# Late rows keep their hour in UTC, whatever offset their text has; resent rows win.
ORACLE["stream_silver"] = with_(ORDER_EVENTS, """arrived AS (
  SELECT event_id AS seq, timestamp AS utc, * REPLACE (CASE WHEN event_id % 10 = 5
      THEN strftime(CAST(left(timestamp, 23) AS TIMESTAMP) + INTERVAL 2 HOURS, '%Y-%m-%dT%H:%M:%S.%g+02:00')
      ELSE timestamp END AS timestamp,
      CASE WHEN event_id % 10 = 1 THEN '999' ELSE amount END AS amount)
  FROM order_events)""") + f"""
SELECT concat('ORDER#', order_id) AS pk, concat('EVENT#', timestamp, '#', event_type) AS sk,
       concat('CUSTOMER#', CAST(customer_id AS VARCHAR)) AS gsi1pk, timestamp AS gsi1sk,
       md5(CAST(event_id AS VARCHAR)) AS event_id, order_id, CAST(customer_id AS VARCHAR) AS customer_id, event_type,
       COALESCE(product, '') AS product, COALESCE(amount, '0') AS amount, status, timestamp,
       substring(utc, 1, 4) AS year, substring(utc, 6, 2) AS month, substring(utc, 9, 2) AS day,
       substring(utc, 12, 2) AS hour
FROM arrived WHERE NOT is_corrupt AND NOT misses_order_id"""


# Gold over the merged state of all change files.
for _name, _gold in (("gold_refresh", "daily_sales"), ("gold_refresh_customer", "customer_summary"),
                     ("gold_refresh_product", "product_ranking"), ("gold_delta", "daily_sales"),
                     ("gold_delta_customer", "customer_summary"), ("gold_delta_product", "product_ranking")):
    ORACLE[_name] = with_(*FEED_CTES, _silver_orders_cte("feed", mode="apply", seq="commit_seq"),
                          BRONZE_CUSTOMERS, SILVER_CUSTOMERS) + GOLD[_gold]

ORACLE["sorted_daily_sales"] = f"""
SELECT *, row_number() OVER (ORDER BY date NULLS FIRST) AS position FROM ({ORACLE["daily_sales"]})"""
ORACLE["sorted_cancellations"] = with_(FLIGHTS, MONTHLY_CANCEL) + f"""
SELECT {ym('month')} AS month, route, cancellations,
       row_number() OVER (ORDER BY month, cancellations DESC, route) AS position FROM monthly"""
ORACLE["sorted_mom_change"] = f"""
SELECT *, row_number() OVER (ORDER BY route, month) AS position FROM ({ORACLE["mom_change"]})"""

ORACLE["in_exists_join_equivalence"] = with_(FLIGHTS) + """
SELECT 'in_subquery' AS method, COUNT(*) AS row_count FROM customer
  WHERE c_custkey IN (SELECT carrier FROM flights)
UNION ALL SELECT 'exists', COUNT(*) FROM customer c
  WHERE EXISTS (SELECT 1 FROM flights f WHERE f.carrier = c.c_custkey)
UNION ALL SELECT 'inner_join', COUNT(*) FROM customer c JOIN flights f ON f.carrier = c.c_custkey
UNION ALL SELECT 'inner_join_distinct', COUNT(DISTINCT c.c_custkey) FROM customer c JOIN flights f ON f.carrier = c.c_custkey
UNION ALL SELECT 'not_exists', COUNT(*) FROM customer c
  WHERE NOT EXISTS (SELECT 1 FROM flights f WHERE f.carrier = c.c_custkey)
UNION ALL SELECT 'not_in_nullable_list', COUNT(*) FROM customer
  WHERE c_custkey NOT IN (SELECT CASE WHEN status = 'CANCELLED' THEN NULL ELSE carrier END FROM flights)"""

ORACLE["catalog_layers"] = with_(BRONZE_ORDERS, SILVER_ORDERS) + """
SELECT 'bronze' AS database, 'orders' AS table_name, 'EXTERNAL' AS table_type, COUNT(*) AS row_count FROM bronze_orders
UNION ALL SELECT 'silver', 'orders', 'EXTERNAL', COUNT(*) FROM silver_orders
UNION ALL SELECT 'gold', 'daily_sales', 'EXTERNAL',
                 COUNT(DISTINCT CAST(created_at AS DATE)) + max(CASE WHEN created_at IS NULL THEN 1 ELSE 0 END)
          FROM silver_orders"""
ORACLE["schema_evolution_diff"] = with_(BRONZE_CUSTOMERS, SILVER_CUSTOMERS) + """
SELECT 'segment' AS "column", 'added' AS change, NULL AS old_type, 'string' AS new_type, 'applied' AS action,
       COUNT(*) FILTER (customer_id % 3 = 0) AS filled_rows FROM silver_customers
UNION ALL SELECT 'email', 'dropped', 'string', NULL, 'logged', COUNT(email) FROM silver_customers
UNION ALL SELECT 'customer_id', 'type_changed', 'int', 'bigint', 'applied',
                 COUNT(*) + COUNT(*) FILTER (customer_id % 3 = 0) FROM silver_customers"""

ORACLE["stream_ingest_latest"] = with_(ORDER_EVENTS, GOOD_EVENTS, ITEMS) + f"""
SELECT {ITEM_COLS} FROM items WHERE seq % 2 = 1"""
