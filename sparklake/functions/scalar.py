"""Column-expression helpers that keep work inside whole-stage codegen.

All helpers return ``Column`` objects built from ``pyspark.sql.functions``;
none of them is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's vocabulary.
# Order-event type -> order status (the producer's status map).
EVENT_STATUS = {
    "order_placed": "pending",
    "order_confirmed": "confirmed",
    "order_shipped": "shipped",
    "order_delivered": "delivered",
    "order_cancelled": "cancelled",
}
# Order lifecycle, in order, plus the one allowed early exit.
ORDER_LIFECYCLE = ("order_placed", "order_confirmed", "order_shipped", "order_delivered")
CANCEL_AFTER = "order_confirmed"
# Labels used by the analytic reports.
TREND_WORSE, TREND_BETTER, TREND_SAME = "PEOR", "MEJOR", "IGUAL"
DAY_IDLE, DAY_ACTIVE = "SIN OPERACION", "OPERATIVO"
QUARTILE_LABELS = {1: "LLENO", 2: "ALTO", 3: "MEDIO", 4: "BAJO"}
# Change-capture operation codes and their precedence for equal timestamps.
OP_RANK = {"I": 0, "U": 1, "D": 2}
# ---------------------------------------------------------------------------


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, scale: int) -> Column:
    """Round through DECIMAL so both Spark and SQL engines round the same way.

    ``round(double)`` is sensitive to binary representation (x.xx5 cases);
    going through ``decimal(38,9)`` makes the half-up decision on the decimal
    digits the user sees.  A value beyond that decimal has no such digits and stays.
    """
    exact = F.round(col(c).try_cast("decimal(38,9)"), scale).cast("double")
    return F.coalesce(exact, col(c).cast("double"))


#: Amounts at or beyond this are no amounts: bad text, like NaN and infinity.
MONEY_LIMIT = 1e18


def money(c) -> Column:
    """Text or number -> double; NULL if it is no finite number below MONEY_LIMIT."""
    x = col(c).try_cast("double")
    return F.when(F.abs(x) < MONEY_LIMIT, x)


def money_digits(c) -> Column:
    """An amount with nine decimals, for sums that don't depend on the order of the rows."""
    return col(c).cast("decimal(38,9)")


def exact_sum(c) -> Column:
    """Order-independent sum of a money column, returned as double; rounding comes last."""
    return F.sum(money_digits(c)).cast("double")


def pct(num, den) -> Column:
    """100 * num / den in double arithmetic (no decimal widening)."""
    return F.lit(100.0) * col(num).cast("double") / col(den).cast("double")


def in_month(c, month: str | _dt.date) -> Column:
    """``date_trunc('month', c) = month`` written as a half-open range.

    The range form is pushed to the Parquet scan; ``trunc(c) = const`` is not.
    """
    m = _dt.date.fromisoformat(str(month)[:7] + "-01")
    nxt = (m.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    return (col(c) >= F.lit(m)) & (col(c) < F.lit(nxt))


def month_start(c) -> Column:
    """First day of the month as DATE (never a zoned timestamp)."""
    return F.trunc(col(c).cast("date"), "MM")


def year_month(c) -> Column:
    """PostgreSQL ``TO_CHAR(d, 'YYYY-MM')``."""
    return F.date_format(col(c), "yyyy-MM")


def clock_time(c) -> Column:
    """PostgreSQL ``TO_CHAR(ts, 'HH24:MI:SS')``."""
    return F.date_format(col(c), "HH:mm:ss")


def dow_sunday0(c) -> Column:
    """PostgreSQL ``EXTRACT(DOW)``: Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(col(c)) - 1


def micros_between(start, end) -> Column:
    """Exact microseconds from ``start`` to ``end``.

    ``timestampdiff`` on TIMESTAMP_NTZ is zone-free, so the answer does not
    depend on the session time zone (no DST hour appears or vanishes).
    """
    return F.timestamp_diff("MICROSECOND", col(start), col(end))


def epoch_minutes_between(start, end) -> Column:
    """``EXTRACT(EPOCH FROM end - start) / 60`` as double."""
    return micros_between(start, end) / F.lit(60_000_000.0)


def iso_ms(c) -> Column:
    """ISO-8601 text with milliseconds and a ``Z`` suffix."""
    return F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def utc_of_iso(c) -> Column:
    """ISO-8601 text -> zone-free UTC timestamp; the text's own offset counts, none means UTC.

    Through the instant's microseconds, so the session time zone has no part in it.
    """
    text = F.trim(col(c))
    zoned = F.when(text.rlike(r"([Zz]|[+-][0-9]{2}:?[0-9]{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.timestamp_add("MICROSECOND", F.unix_micros(zoned.try_cast("timestamp")),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def status_of_event(c) -> Column:
    """Event type -> status lookup as a literal map (unknown type -> NULL)."""
    pairs = []
    for k, v in EVENT_STATUS.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)[col(c)]


def stable_id(*cols) -> Column:
    """Deterministic identifier from a natural key (instead of ``uuid()``)."""
    return F.sha2(F.concat_ws("\u0001", *[col(c).cast("string") for c in cols]), 256)
