"""Change-capture operators: snapshot, change feed, current state."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklake.operators.dedup import dedup_changes

OPS_EMITTED = ("I", "U")  # deletes are not emitted by an insert/update-only capture


def _like(pattern: str) -> re.Pattern:
    """SQL ``LIKE``: ``%`` is any text, ``_`` one character, all else itself."""
    return re.compile("".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in pattern), re.DOTALL)


def select_tables(names, include=("%",), exclude=()) -> list[str]:
    """Table selection rules with SQL ``LIKE`` patterns (``%`` and ``_``).

    Names are ``table`` or ``schema.table``.  A rule is one pattern for the table, in any
    schema, or a (schema, table) pair of patterns.  Works on catalog metadata (a
    list of names), never on rows.
    """
    def hit(name, rule):
        of_schema, of_table = rule if isinstance(rule, tuple) else ("%", rule)
        schema, _, table = name.rpartition(".")
        return bool(_like(of_schema).fullmatch(schema) and _like(of_table).fullmatch(table))
    return [n for n in names
            if any(hit(n, r) for r in include) and not any(hit(n, r) for r in exclude)]


def full_load(df: DataFrame, op: str = "I") -> DataFrame:
    """Snapshot of a whole table, each row flagged with the load op."""
    return df.withColumn("op", F.lit(op))


def change_feed(snapshot: DataFrame, *changes: DataFrame, seq: str = "commit_seq") -> DataFrame:
    """Snapshot followed by change files, each tagged with its commit order."""
    out = snapshot.withColumn(seq, F.lit(0))
    for i, ch in enumerate(changes, start=1):
        out = out.unionByName(ch.withColumn(seq, F.lit(i)))
    return out


def inserts_updates(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("op").isin(*OPS_EMITTED))


def current_state(feed: DataFrame, key: str, *, mode: str = "apply",
                  ts: str = "updated_at") -> DataFrame:
    """Current rows from a change feed.

    ``mode="filter"``: drop delete rows first, then keep the latest row per key
    (the I/U rows of a deleted key survive; NULL ops are dropped too).
    ``mode="apply"``: the latest change per key wins and deleted keys vanish.
    """
    if mode == "filter":
        return dedup_changes(feed.filter(F.col("op") != "D"), key, ts=ts)
    if mode == "apply":
        latest = dedup_changes(feed.filter(F.col("op").isNotNull()), key, ts=ts)
        return latest.filter(F.col("op") != "D")
    raise ValueError(f"unknown mode {mode!r}")
