"""Operators over one global order that do not funnel into a single task.

A window with ``ORDER BY`` and no ``PARTITION BY`` makes Spark move every row
into one partition (``Exchange SinglePartition``).  Here each row is tagged with a
range of the full, unique ordering key, so equal values of the leading column (a
hot timestamp, a popular value) are spread over many ranges.  Each range is
processed locally; the ranges are then stitched through a table with one row per
range (its size is bounded by the range count, which is what makes its broadcast
safe).

The rows are written once (the columns that the caller has selected), so that the input is computed once,
whatever reads it again, and are counted on the way.  The range bounds are a *splitter tree* that Spark computes
from them at run time: the rows whose key hash lies below a share of the hash space are a sample of bounded size, which is
sorted, and every so-manieth key is a bound.  The plan holds it as a scalar subquery, so
neither its size nor the time to plan it depends on the number of ranges, and no bound is collected while a
query is built.  Beyond ``ONE_LEVEL`` ranges the root holds the bounds of as many coarse parts as there are bounds in each,
and each part's own bounds come from the sampled keys of that part, in a table of one row a part.  The sample depends on
the rows alone: every branch, retry and re-run cuts the same ranges.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklake.functions.scalar import col
from sparklake.operators.joins import written

PID = "_range_id"
#: Sampled rows for each range, on average.
SAMPLE_PER_RANGE = 20
#: Ranges up to which one array of bounds serves.
ONE_LEVEL = 2_000


class Key(NamedTuple):
    """One ordering column with its direction."""

    column: Column
    descending: bool
    nulls_first: bool


def _num_ranges(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _order_cols(order: Sequence) -> list[Column]:
    return [col(c) for c in order]


def _keys(order: Sequence) -> list[Key]:
    """Names and columns ascend with nulls first; ``desc()`` and the like are read from the column."""
    keys = []
    for c in order:
        found = re.fullmatch(r"Column<'(.*) (ASC|DESC) NULLS (FIRST|LAST)'>", str(c), re.DOTALL)
        if found:
            keys.append(Key(F.expr(found[1]), found[2] == "DESC", found[3] == "FIRST"))
        else:
            keys.append(Key(col(c), False, True))
    return keys


def _ascending(df: DataFrame, keys: list[Key]) -> list[Key]:
    """The same order with ascending keys, nulls first, as far as the types have an opposite.

    Structs of such keys compare as they are, in generated code.
    """
    out = []
    for k in keys:
        kind, c = df.select(k.column.alias("k")).schema["k"].dataType, k.column
        if k.descending:
            if isinstance(kind, T.IntegralType):
                c = F.bitwise_not(c)  # the opposite of every value, the least one too
            elif isinstance(kind, T.DateType):
                c = F.bitwise_not(F.unix_date(c))
            elif isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
                c = -c
            else:
                out.append(k)
                continue
        if k.descending or not k.nulls_first:
            out.append(Key(k.column.isNotNull() if k.nulls_first else k.column.isNull(), False, True))
        if k.descending and isinstance(kind, (T.DoubleType, T.FloatType)):
            out.append(Key(~F.isnan(k.column), False, True))  # NaN is the greatest, and its own opposite
        out.append(Key(c, False, True))
    return out


def _plain(keys: list[Key]) -> bool:
    """Whether the order is that of structs."""
    return all(not k.descending and k.nulls_first for k in keys)


def _at_or_after(key: Column, bound: Column, keys: list[Key]) -> Column:
    """Whether ``key`` is at or after ``bound`` in the order; both are structs k0, k1, ..."""
    if _plain(keys):
        return key >= bound
    out = F.lit(True)
    for i, k in reversed(list(enumerate(keys))):
        v, b = key[f"k{i}"], bound[f"k{i}"]
        after = (F.when(v.isNull(), F.lit(not k.nulls_first))
                  .when(b.isNull(), F.lit(k.nulls_first))
                  .otherwise(v < b if k.descending else v > b))
        out = F.when(v.eqNullSafe(b), out).otherwise(after)
    return out


def _sorted_bounds(keys: list[Key], n: int) -> Column:
    """Aggregate of the struct column ``key``: up to n - 1 keys, in order, that cut the group into parts of like size."""
    after = lambda a, b: F.when(a.eqNullSafe(b), 0).when(_at_or_after(a, b, keys), 1).otherwise(-1)
    held = F.collect_list("key")
    in_order = F.sort_array(held) if _plain(keys) else F.array_sort(held, after)
    # the sorted array is a lambda's variable, so that it is sorted once
    picked = F.transform(F.array(in_order), lambda s: F.transform(
        F.filter(F.sequence(F.lit(1), F.lit(max(n - 1, 1))), lambda i: (F.size(s) > 0) & F.lit(n > 1)),
        lambda i: F.get(s, F.floor(i.cast("long") * F.size(s) / n).cast("int"))))[0]
    return F.array_distinct(picked)  # keeps the order


def _with_search(df: DataFrame, name: str, key: Column, bounds: Column, keys: list[Key], most: int) -> DataFrame:
    """``df`` with the number of bounds at or before ``key``; ``bounds`` is a sorted array of ``most`` keys at most.

    A binary search as one projection a step, all of one generated stage: rows never carry the array.
    """
    at = F.lit(0)
    out = df.select("*", bounds.alias("_bounds"), key.alias("_key"))
    for i in reversed(range(most.bit_length())):
        bound = F.get("_bounds", at + (2**i - 1))  # NULL beyond the last
        before = bound.isNotNull() & _at_or_after(F.col("_key"), bound, keys)
        out = out.withColumn("_at", at + F.when(before, 2**i).otherwise(0))
        at = F.col("_at")
    return out.withColumn(name, at).drop("_bounds", "_key", "_at")


def ranged(df: DataFrame, order: Sequence, num_ranges: int | None = None) -> DataFrame:
    """Tag each row with its range of ``order``; ranges follow each other in the order."""
    n = _num_ranges(df, num_ranges)
    if n < 2:
        return df.withColumn(PID, F.lit(0))
    df, rows = written(df, "ranged")
    keys = _ascending(df, _keys(order))
    key = F.struct(*[k.column.alias(f"k{i}") for i, k in enumerate(keys)])
    named = df.select(key.alias("key"))
    point = F.xxhash64(F.lit(n), "key").bitwiseAND(F.lit(2**53 - 1)) / F.lit(float(2**53))
    sample = named.where(point * rows < n * SAMPLE_PER_RANGE)
    if n <= ONE_LEVEL:
        bounds = sample.agg(_sorted_bounds(keys, n)).scalar()
        return _with_search(df, PID, key, bounds, keys, n)
    parts = math.isqrt(n - 1) + 1
    thin = sample.where(point * rows < parts * SAMPLE_PER_RANGE)
    root = thin.agg(_sorted_bounds(keys, parts)).scalar()
    leaves = (_with_search(sample, "_part", F.col("key"), root, keys, parts)
              .groupBy("_part").agg(_sorted_bounds(keys, -(-n // parts)).alias("_leaf")))
    tagged = _with_search(df, "_part", key, root, keys, parts)
    each = -(-n // parts)
    found = _with_search(tagged.join(F.broadcast(leaves), "_part", "left"), PID, key, F.col("_leaf"), keys, each)  # n bounds in all
    return found.select(*[F.col(quoted(c)) for c in df.columns], (F.col("_part") * (each + 1) + F.col(PID)).alias(PID))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def global_position(df: DataFrame, order: Sequence, *, name: str = "_pos",
                    total: str | None = None, num_ranges: int | None = None) -> DataFrame:
    """1-based position of each row in the global ``order`` (a distributed
    ``row_number() OVER (ORDER BY order)``).  ``order`` must be unique."""
    r = ranged(df, order, num_ranges)
    w = Window.partitionBy(PID).orderBy(*_order_cols(order))
    r = r.withColumn("_rn", F.row_number().over(w))
    sizes = r.groupBy(PID).agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        PID,
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_total"))
    out = r.join(F.broadcast(offsets), PID).withColumn(name, F.col("_off") + F.col("_rn"))
    if total:
        out = out.withColumnRenamed("_total", total)
    return out.drop(PID, "_rn", "_off", "_total")


def global_lead(df: DataFrame, order: Sequence, values: Sequence[str], *,
                prefix: str = "next_", num_ranges: int | None = None) -> DataFrame:
    """``LEAD(v) OVER (ORDER BY order)`` for each v in ``values``.

    Inside each range the lead is a window over that range only; the last row
    of a range takes the first row of the next non-empty range.
    """
    order_cols = _order_cols(order)
    r = ranged(df, order, num_ranges)
    w = Window.partitionBy(PID).orderBy(*order_cols)
    r = r.withColumn("_has_next", F.lead(F.lit(1)).over(w))
    for v in values:
        r = r.withColumn(prefix + v, F.lead(v).over(w))
    firsts = r.groupBy(PID).agg(
        F.min_by(F.struct(*[F.col(v) for v in values]), F.struct(*order_cols)).alias("_first"))
    nxt = firsts.select(PID, F.lead("_first").over(Window.orderBy(PID)).alias("_next_first"))
    out = r.join(F.broadcast(nxt), PID, "left")
    edge = F.col("_has_next").isNull()
    for v in values:
        out = out.withColumn(prefix + v, F.when(edge, F.col("_next_first." + v))
                             .otherwise(F.col(prefix + v)))
    return out.drop(PID, "_next_first", "_has_next")


def ntile_from_position(pos: Column, total: Column, k: int) -> Column:
    """Bucket of a 1-based position among ``total`` rows, NTILE rules: the
    first ``total mod k`` buckets hold one extra row."""
    q = F.floor(total / k)
    r = total % k
    big = r * (q + 1)
    return F.when(pos <= big, F.floor((pos - 1) / (q + 1)) + 1) \
            .otherwise(r + F.floor((pos - big - 1) / q) + 1).cast("bigint")


def global_ntile(df: DataFrame, order: Sequence, k: int, *, name: str = "ntile",
                 num_ranges: int | None = None) -> DataFrame:
    """``NTILE(k) OVER (ORDER BY order)`` without a single-partition exchange."""
    p = global_position(df, order, name="_pos", total="_n", num_ranges=num_ranges)
    return p.withColumn(name, ntile_from_position(F.col("_pos"), F.col("_n"), k)).drop("_pos", "_n")


def keyed_shift(df: DataFrame, by: Sequence[str], order: Sequence, values: Sequence[str], *,
                direction: str = "lead", prefix: str | None = None,
                num_ranges: int | None = None) -> DataFrame:
    """``LEAD``/``LAG`` of ``values`` over ``PARTITION BY by ORDER BY order``.

    Rows are range-partitioned on ``(by, order)`` (unique), so one key with a
    large share of the rows is split across several ranges; the shift is
    computed inside each (range, key) and the boundary row of a range is
    completed from the neighbouring range when that row belongs to the same key.
    """
    by = list(by)
    prefix = prefix if prefix is not None else ("next_" if direction == "lead" else "prev_")
    order_cols = _order_cols(order)
    full = [F.col(k) for k in by] + order_cols
    r = ranged(df, full, num_ranges)
    w = Window.partitionBy(PID, *by).orderBy(*order_cols)
    fn = F.lead if direction == "lead" else F.lag
    r = r.withColumn("_has_nb", fn(F.lit(1)).over(w))
    for v in values:
        r = r.withColumn(prefix + v, fn(v).over(w))
    payload = F.struct(*[F.col(k) for k in by], *[F.col(v) for v in values])
    if direction == "lead":
        edge = r.groupBy(PID).agg(F.min_by(payload, F.struct(*full)).alias("_edge"))
        nb = edge.select(PID, F.lead("_edge").over(Window.orderBy(PID)).alias("_nb"))
    else:
        edge = r.groupBy(PID).agg(F.max_by(payload, F.struct(*full)).alias("_edge"))
        nb = edge.select(PID, F.lag("_edge").over(Window.orderBy(PID)).alias("_nb"))
    out = r.join(F.broadcast(nb), PID, "left")
    same_key = F.lit(True)
    for k in by:
        same_key = same_key & F.col(k).eqNullSafe(F.col("_nb." + k))
    edge = F.col("_has_nb").isNull()
    for v in values:
        out = out.withColumn(prefix + v, F.when(edge, F.when(same_key, F.col("_nb." + v)))
                             .otherwise(F.col(prefix + v)))
    return out.drop(PID, "_nb", "_has_nb")


def _ranges_with_positions(df: DataFrame, full: list[Column], num_ranges: int | None):
    """Ranges, each row with its in-range number ``_rn`` and the
    per-range table (range id, dense index, offset, size)."""
    r = ranged(df, full, num_ranges)
    r = r.withColumn("_rn", F.row_number().over(Window.partitionBy(PID).orderBy(*full)))
    sizes = r.groupBy(PID).agg(F.count(F.lit(1)).alias("_cnt"))
    by_pid = Window.orderBy(PID)
    table = sizes.select(
        PID, "_cnt",
        F.row_number().over(by_pid).alias("_idx"),
        F.coalesce(F.sum("_cnt").over(by_pid.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return r, table


def _within_reach(table: DataFrame, preceding: int) -> DataFrame:
    """(_from, _targets): per range, the later ranges that begin less than ``preceding`` rows after its end."""
    reach = Window.orderBy("_off").rangeBetween(Window.currentRow, preceding)
    begins = table.select(PID, "_idx", "_off", F.lit(None).cast("int").alias("_from"))
    ends = table.select(F.lit(None).cast("int").alias(PID), "_idx", (F.col("_off") + F.col("_cnt")).alias("_off"),
                        F.col(PID).alias("_from"))
    both = begins.unionByName(ends)
    target = F.when(F.col(PID).isNotNull(), F.struct(F.col(PID).alias("pid"), F.col("_idx").alias("idx"), F.col("_off").alias("off")))
    met = both.select("_from", "_idx", F.collect_list(target).over(reach).alias("_met")).where("_from IS NOT NULL")
    return met.select("_from", F.filter("_met", lambda t: t["idx"] > F.col("_idx")).alias("_targets"))


def keyed_sliding(df: DataFrame, by: Sequence[str], order: Sequence, preceding: int,
                  aggs: dict, *, num_ranges: int | None = None) -> DataFrame:
    """Aggregates over ``ROWS BETWEEN preceding PRECEDING AND CURRENT ROW`` of
    ``PARTITION BY by ORDER BY order`` (``order`` must make rows unique within a key).

    ``aggs`` maps an output name to a function ``WindowSpec -> Column``.
    Rows are range-partitioned on (by, order), so a key holding a third of the
    rows is split over many tasks.  Each range also receives a *halo*: copies of
    the ``preceding`` rows that come right before it in the global order, so the
    frame of its first rows is complete; halo rows are dropped after the window.
    The halo is at most ``preceding`` rows per range.
    """
    by = list(by)
    full = [F.col(k) for k in by] + _order_cols(order)
    r, table = _ranges_with_positions(df, full, num_ranges)
    t = F.broadcast(table)  # one row per range
    r = r.join(t, PID)
    cols = df.columns
    # the ranges that begin within reach of a range's last row: mostly one, and never more than
    # lie between it and the end of its reach
    later = _within_reach(table, preceding)
    near = (r.filter(F.col("_rn") > F.col("_cnt") - preceding).withColumn("_g", F.col("_off") + F.col("_rn"))
             .join(F.broadcast(later), F.col(PID) == F.col("_from")))  # one row per range
    halo = (near.withColumn("_to", F.explode(F.filter(
                "_targets", lambda t: (t["off"] >= F.col("_g")) & (t["off"] - preceding < F.col("_g")))))
                .select(*cols, F.col("_to.pid").alias(PID), F.lit(True).alias("_halo")))
    rows = r.select(*cols, PID, F.lit(False).alias("_halo")).unionByName(halo)
    w = Window.partitionBy(PID, *by).orderBy(*full).rowsBetween(-preceding, Window.currentRow)
    out = rows.select(*cols, "_halo", *[fn(w).alias(name) for name, fn in aggs.items()])
    return out.filter(~F.col("_halo")).drop("_halo")


def keyed_position(df: DataFrame, by: Sequence[str], order: Sequence, *, name: str = "pos",
                   num_ranges: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY by ORDER BY order)`` (equivalently a
    ``COUNT(*)`` over ``ROWS UNBOUNDED PRECEDING``) with hot keys split over ranges.

    position = global position - global position of the key's first row.  The
    key's first row is found inside each range by a window (same partitioning,
    no extra shuffle); only a key that continues from earlier ranges needs more,
    and that is carried through the per-range table: a key can only enter a
    range as its first key, and passes through a range only if it fills it.
    """
    by = list(by)
    full = [F.col(k) for k in by] + _order_cols(order)
    r, table = _ranges_with_positions(df, full, num_ranges)
    r = r.join(F.broadcast(table), PID).withColumn("_g", F.col("_off") + F.col("_rn"))
    r = r.withColumn("_kfirst", F.min("_g").over(Window.partitionBy(PID, *by)))
    key = F.struct(*[F.col(k) for k in by])
    edges = r.groupBy(PID).agg(
        F.min_by(key, F.col("_rn")).alias("_fk"),
        F.max_by(F.struct(key.alias("k"), F.col("_kfirst").alias("kf")), F.col("_rn")).alias("_last"))
    w = Window.orderBy(PID)
    chained = F.coalesce(F.lag(F.col("_last.k")).over(w).eqNullSafe(F.col("_fk")), F.lit(False))
    e = edges.select(PID, "_fk", "_last", chained.alias("_chained"))
    single = F.col("_fk").eqNullSafe(F.col("_last.k"))
    e = e.withColumn("_island", F.sum(F.when(F.col("_chained") & single, 0).otherwise(1)).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    e = e.withColumn("_carry_out", F.first("_last.kf").over(
        Window.partitionBy("_island").orderBy(PID).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    e = e.select(PID, "_fk", F.when(F.col("_chained"), F.lag("_carry_out").over(w)).alias("_carry_in"))
    out = r.join(F.broadcast(e), PID)  # one row per range
    first = F.when(F.col("_carry_in").isNotNull() & key.eqNullSafe(F.col("_fk")), F.col("_carry_in")) \
             .otherwise(F.col("_kfirst"))
    return out.select(*df.columns, (F.col("_g") - first + 1).cast("bigint").alias(name))
