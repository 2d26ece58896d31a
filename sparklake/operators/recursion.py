"""Recursion over DataFrames: semi-naive steps to a fixed point."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from sparklake.operators.joins import written


class TooDeep(RuntimeError):
    """A recursion that had not ended after the levels it was allowed."""


def fixpoint(base: DataFrame, step: Callable[[DataFrame], DataFrame], *, most_levels: int = 100) -> DataFrame:
    """All distinct rows of ``base``, of ``step`` of them, of ``step`` of those, and so on, until a level adds nothing new.

    Only the rows that the last level added are stepped again, so a cycle ends by itself.  Each level is written
    once below the shared checkpoint folder, which cuts the plan: it does not grow with the depth, and a lost executor
    costs one level at most.  NULLs count as equal; columns go by place, as in SQL.  Raises ``TooDeep`` after ``most_levels`` levels that added rows.
    """
    level, rows = written(base.distinct(), "fixpoint")
    found, depth = level, 0
    while rows:
        if depth == most_levels:
            raise TooDeep(f"the recursion still added {rows} rows at level {depth}")
        level, rows = written(step(level).toDF(*base.columns).subtract(found), "fixpoint")
        found, depth = found.unionAll(level), depth + 1
    return found
