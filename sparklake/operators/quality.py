"""Data-quality rules (table constraints re-aimed as Spark jobs).

Every report has the columns (rule, column, violations, sample_key): one row
per checked column or key, computed in a single aggregation pass per table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_COLS = ["rule", "column", "violations", "sample_key"]


def _key_text(cols: Sequence[str]):
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols])


def _report(df_one_row: DataFrame, rule: str, names: Sequence[str]) -> DataFrame:
    """Turn one wide row (v_<i>, s_<i>) into one report row per name."""
    parts = [F.struct(F.lit(rule).alias("rule"), F.lit(n).alias("column"),
                      F.col(f"v_{i}").cast("bigint").alias("violations"),
                      F.col(f"s_{i}").cast("string").alias("sample_key"))
             for i, n in enumerate(names)]
    return df_one_row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def not_null(df: DataFrame, cols: Sequence[str] | None = None, key: str | None = None) -> DataFrame:
    cols = list(cols or df.columns)
    key = key or cols[0]
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"v_{i}"),
                 F.min(F.when(F.col(c).isNull(), F.col(key).cast("string"))).alias(f"s_{i}")]
    return _report(df.agg(*aggs), "not_null", cols)


def accepted_values(df: DataFrame, allowed: Mapping[str, Sequence], key: str) -> DataFrame:
    """CHECK (c IN (...)): NULL passes, as in SQL."""
    aggs, names = [], list(allowed)
    for i, c in enumerate(names):
        bad = F.col(c).isNotNull() & ~F.col(c).isin(*allowed[c])
        aggs += [F.count_if(bad).alias(f"v_{i}"),
                 F.min(F.when(bad, F.col(key).cast("string"))).alias(f"s_{i}")]
    return _report(df.agg(*aggs), "accepted_values", names)


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (group count > 1; partial aggregation first).  As in
    SQL, a key with a NULL in it equals no other."""
    dup = (df.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
             .select(_key_text(keys).alias("k")))
    one = dup.agg(F.count(F.lit(1)).alias("v_0"), F.min("k").alias("s_0"))
    return _report(one, "unique", [",".join(keys)])


def foreign_key(child: DataFrame, fk: Sequence[str], parent: DataFrame, pk: Sequence[str],
                name: str | None = None) -> DataFrame:
    """Child rows whose key has no parent (NOT EXISTS as a left-anti join).

    The child is first reduced to (key, rows) with a map-side combined count,
    so a hot key is one row per task before the anti join; the parent side is
    reduced to its distinct keys the same way.
    """
    keyed = (child.select(*fk).filter(" AND ".join(f"{c} IS NOT NULL" for c in fk))
                  .groupBy(*fk).agg(F.count(F.lit(1)).alias("_rows")))
    parents = parent.select(*[F.col(b).alias(a) for a, b in zip(fk, pk)]).distinct()
    orphans = keyed.join(parents, list(fk), "left_anti")
    one = orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("v_0"), F.min(_key_text(fk)).alias("s_0"))
    return _report(one, "foreign_key", [name or ",".join(fk)])


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill absent columns and NULL values with their declared default."""
    out = df
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v))
    return out


def defaults_report(df: DataFrame, defaults: Mapping[str, object], key: str) -> DataFrame:
    names = list(defaults)
    aggs = []
    for i, c in enumerate(names):
        miss = F.col(c).isNull() if c in df.columns else F.lit(True)
        aggs += [F.count_if(miss).alias(f"v_{i}"),
                 F.min(F.when(miss, F.col(key).cast("string"))).alias(f"s_{i}")]
    return _report(df.agg(*aggs), "default_applied", names)


def bounds(df: DataFrame, key: str, max_length: Mapping[str, int] | None = None,
           decimals: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """VARCHAR(n) length and NUMERIC(p,s) fit, as violation counts."""
    checks = []
    for c, n in (max_length or {}).items():
        checks.append((f"{c}<= {n} chars", F.length(F.col(c)) > n))
    for c, (p, s) in (decimals or {}).items():
        bad = F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()
        checks.append((f"{c} fits decimal({p},{s})", bad))
    aggs = []
    for i, (_, bad) in enumerate(checks):
        aggs += [F.count_if(bad).alias(f"v_{i}"),
                 F.min(F.when(bad, F.col(key).cast("string"))).alias(f"s_{i}")]
    return _report(df.agg(*aggs), "bounds", [n for n, _ in checks])
