"""One-row-per-key operators.

Written as ``row_number() OVER (PARTITION BY key ORDER BY ...) = 1``, which
Catalyst plans with a *partial* ``WindowGroupLimit`` before the shuffle: each
map task keeps one row per key, so a key holding a third of all rows is
reduced map-side instead of landing whole in one task.  (Measured ~30% faster
than a ``max_by(struct)`` aggregate, which falls back to an interpreted
sort-based aggregate.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparklake.functions.scalar import OP_RANK, col


def _as_cols(cs) -> list[Column]:
    if cs is None:
        return []
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [col(c) for c in cs]


def _pick_first(df: DataFrame, keys: Sequence[str], ordering: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_pick", F.row_number().over(w)).filter(F.col("_pick") == 1).drop("_pick")


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence, *,
                  tiebreak_all: bool = True) -> DataFrame:
    """Keep, per key, the row with the greatest ``order`` (NULL smallest).
    Remaining ties are broken by all other columns, so the pick is
    deterministic (never an arbitrary survivor)."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    ordering = [c.desc_nulls_last() for c in _as_cols(order)]
    if tiebreak_all:
        ordering += [F.col(c).desc_nulls_last() for c in others]
    return _pick_first(df, keys, ordering)


def earliest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    ordering = [c.asc_nulls_first() for c in _as_cols(order)] + [F.col(c).asc_nulls_first() for c in others]
    return _pick_first(df, keys, ordering)


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence, *, descending=True) -> DataFrame:
    """PostgreSQL ``DISTINCT ON (keys) ... ORDER BY keys, order`` (first row per key)."""
    return (latest_by_key if descending else earliest_by_key)(df, keys, order)


def op_rank(c="op") -> Column:
    pairs = []
    for k, v in OP_RANK.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.create_map(*pairs)[col(c)], F.lit(-1))


def dedup_changes(df: DataFrame, key: str, *, ts: str = "updated_at", op: str = "op",
                  seq: str = "commit_seq") -> DataFrame:
    """Ruling R3: one row per primary key, the last by commit order (``seq``, where the
    feed has it), then by ``ts`` (parsed), then by operation precedence (I < U < D),
    then by all columns."""
    ordering = [F.col(seq)] if seq in df.columns else []
    if ts in df.columns:
        ordering.append(F.col(ts).try_cast("timestamp_ntz"))
    if op in df.columns:
        ordering.append(op_rank(op))
    return latest_by_key(df, [key], ordering)
