"""Small hand-written inputs shaped like the source system's seed data."""

import datetime as dt

from pyspark.sql import functions as F

# The seed system log (timestamp, system), 30 events on 2025-03-15.
SEED_LOG = [
    ("08:00:00", "check-in"), ("08:05:12", "check-in"), ("08:09:45", "boarding"),
    ("08:14:22", "boarding"), ("08:19:08", "check-in"), ("09:01:33", "check-in"),
    ("09:06:17", "boarding"), ("09:11:55", "boarding"), ("09:16:40", "check-in"),
    ("09:21:05", "boarding"), ("09:26:50", "check-in"), ("11:03:22", "check-in"),
    ("11:08:11", "boarding"), ("11:13:45", "check-in"), ("11:18:30", "boarding"),
    ("11:23:14", "check-in"), ("12:18:05", "check-in"), ("12:23:41", "boarding"),
    ("12:28:19", "check-in"), ("12:33:02", "boarding"), ("12:38:55", "check-in"),
    ("12:44:10", "boarding"), ("14:55:00", "check-in"), ("15:00:30", "boarding"),
    ("15:05:45", "check-in"), ("15:10:22", "boarding"), ("15:15:08", "check-in"),
    ("15:43:00", "boarding"), ("15:48:15", "check-in"), ("15:53:40", "boarding"),
]


# A few flights by hand: (route, date, status, passengers); ids follow the order of the list.
HAND_FLIGHTS = [
    ("A", "2025-01-01", "COMPLETED", 90), ("A", "2025-01-02", "CANCELLED", 10), ("A", "2025-01-03", "COMPLETED", 180),
    ("A", "2025-01-05", "DELAYED", 45), ("A", "2025-01-09", "CANCELLED", 20), ("A", "2025-02-01", "CANCELLED", 30),
    ("A", "2025-02-02", "CANCELLED", 30), ("A", "2025-02-03", "CANCELLED", 30), ("A", "2025-02-10", "COMPLETED", 60),
    ("B", "2025-01-01", "CANCELLED", 5), ("B", "2025-01-01", "COMPLETED", 144), ("B", "2025-01-04", "COMPLETED", 126),
    ("B", "2025-02-01", "DELAYED", 36), ("B", "2025-02-02", "COMPLETED", 72), ("B", "2025-02-28", "COMPLETED", 108),
    ("C", "2025-01-31", "COMPLETED", 18), ("C", "2025-02-01", "COMPLETED", 54),
]
CAPACITY = 180


def hand_flights(spark):
    rows = [(i + 1, r, dt.date.fromisoformat(d), s, p, CAPACITY, r) for i, (r, d, s, p) in enumerate(HAND_FLIGHTS)]
    return spark.createDataFrame(rows, "id bigint, route string, flight_date date, status string, passengers int, "
                                       "capacity int, carrier string")


def seed_log(spark):
    rows = [(i + 1, dt.datetime.fromisoformat(f"2025-03-15 {t}"), s) for i, (t, s) in enumerate(SEED_LOG)]
    return (spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, system string")
                 .withColumn("severity", F.lit("INFO")))
