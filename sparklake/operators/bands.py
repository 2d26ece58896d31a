"""Band (range) lookback on raw rows: what happened to the same key in a stretch of time before each row.

Two forms.  ``band_totals`` gives counts and sums and never makes a pair: it takes the difference of two running totals
of one global order, so a key, or a moment, that holds a third of all rows is split over many ranges.  ``band_pairs`` gives
the pairs themselves: rows meet by equal (key, time bin), so a hot key is split by bin, and the exact
condition follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparklake.operators.ordered import PID, quoted, ranged


def _micros(at: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(quoted(at)).cast("timestamp_ntz"))


def _known(df: DataFrame, by: Sequence[str], at: str) -> Column:
    ok = F.col(quoted(at)).isNotNull()
    for k in by:
        ok &= F.col(quoted(k)).isNotNull()
    return ok


def band_totals(probes: DataFrame, facts: DataFrame, by: Sequence[str], probe_at: str, fact_at: str, micros: int, *,
                count: str = "n", sums: dict[str, str] | None = None, inclusive: bool = False,
                num_ranges: int | None = None) -> DataFrame:
    """Each probe with the number of facts of its key in ``[t - micros, t)``, or ``[t - micros, t]`` if ``inclusive``.

    ``sums`` maps an output name to a fact column of an integer or decimal type, whose total (NULL without any value) is
    added; running totals of doubles would lose digits.  Probes and facts become points of one order (key, time, probe ends
    around facts); a running total over its ranges gives at each end what lies before, and the two ends of a probe differ by
    what lies between.  A NULL key or time meets nothing: the probe stays, with 0.
    """
    sums = sums or {}
    keys = [f"_k{i}" for i in range(len(by))]
    amounts = [c for i in range(len(sums)) for c in (f"_v{i}", f"_c{i}")]
    values = [c for i, s in enumerate(sums.values()) for c in (
        F.coalesce(F.col(quoted(s)), F.lit(0).cast(facts.schema[s].dataType)).alias(f"_v{i}"),
        F.col(quoted(s)).isNotNull().cast("long").alias(f"_c{i}"))]
    known = facts.where(_known(facts, by, fact_at)).select(
        *[F.col(quoted(k)).alias(n) for k, n in zip(by, keys)], _micros(fact_at).alias("_when"), F.lit(1).alias("_side"),
        F.monotonically_increasing_id().alias("_uid"), F.lit(1).cast("long").alias("_one"), *values)
    # both ends of a probe in one row, so that they share its number
    ends = F.array(
        F.struct((F.col("_t") - micros).alias("_when"), F.lit(0).alias("_side"), F.lit(False).alias("_last")),
        F.struct(F.col("_t").alias("_when"), F.lit(2 if inclusive else 0).alias("_side"), F.lit(True).alias("_last")))
    held = F.struct(*[F.col(quoted(c)) for c in probes.columns])
    asked = probes.select(*[F.col(quoted(k)).alias(n) for k, n in zip(by, keys)], _micros(probe_at).alias("_t"), held.alias("_row"),
                          F.monotonically_increasing_id().alias("_uid")).select(*keys, "_uid", "_row", F.inline(ends))
    asked = asked.withColumn("_row", F.when(F.col("_last"), F.col("_row")))
    points = known.unionByName(asked, allowMissingColumns=True)
    order = [*keys, "_when", "_side", "_uid", "_last"]
    r = ranged(points, order, num_ranges)
    running = Window.partitionBy(PID).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = ["_one", *amounts]
    zero = {c: F.lit(0).cast(points.schema[c].dataType) for c in totals}
    inside = r.select(*keys, "_uid", "_last", "_row", "_side", PID,
                      *[F.sum(F.coalesce(F.col(c), zero[c])).over(running).alias(f"_in{c}") for c in totals])
    per_range = r.groupBy(PID).agg(*[F.coalesce(F.sum(c), zero[c]).alias(f"_all{c}") for c in totals])
    earlier = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    before = per_range.select(PID, *[F.coalesce(F.sum(f"_all{c}").over(earlier), zero[c]).alias(f"_before{c}") for c in totals])
    at_ends = inside.where("_last IS NOT NULL").join(F.broadcast(before), PID)  # one row per range
    at_end = {c: F.col(f"_in{c}") + F.col(f"_before{c}") for c in totals}
    between = [(F.sum(F.when(F.col("_last"), at_end[c]).otherwise(zero[c]))
                - F.sum(F.when(F.col("_last"), zero[c]).otherwise(at_end[c]))).alias(f"_d{c}") for c in totals]
    per_probe = at_ends.groupBy("_uid").agg(F.any_value("_row", True).alias("_row"), *between)
    return per_probe.select("_row.*", F.col("_d_one").alias(count), *[
        F.when(F.col(f"_d_c{i}") > 0, F.col(f"_d_v{i}")).alias(name) for i, name in enumerate(sums)])


def band_pairs(left: DataFrame, right: DataFrame, by: Sequence[str], left_at: str, right_at: str, micros: int) -> DataFrame:
    """Pairs of ``left`` and ``right`` rows of one key with the right time in ``[left - micros, left)``.

    The columns of ``left`` come as they are, those of ``right`` besides ``by`` must have other names.  A bin is as long as the
    band: a left row is looked up in its own bin and the one before, a right row lies in one.  NULL keys and times pair
    with nothing.
    """
    others = [c for c in right.columns if c not in by]
    t = _micros(left_at)
    a = left.where(_known(left, by, left_at)).withColumn("_t", t).withColumn(
        "_bin", F.explode(F.array(F.floor(F.col("_t") / F.lit(micros)), F.floor(F.col("_t") / F.lit(micros)) - 1)))
    b = right.where(_known(right, by, right_at)).select(
        *[F.col(quoted(c)) for c in right.columns], _micros(right_at).alias("_u")).withColumn("_bin", F.floor(F.col("_u") / F.lit(micros)))
    met = a.join(b, [*by, "_bin"]).where((F.col("_u") < F.col("_t")) & (F.col("_u") >= F.col("_t") - micros))
    return met.select(*[F.col(quoted(c)) for c in left.columns], *[F.col(quoted(c)) for c in others])
