"""Typed casts that never fail a job: bad text becomes NULL and is counted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def typed_cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """``try_cast`` each listed column (Spark 4's ANSI ``cast`` would raise)."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])


def cast_rejects(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per column: values present as text that do not parse as the target type."""
    names = list(types)
    aggs = []
    for i, c in enumerate(names):
        bad = F.col(c).isNotNull() & F.col(c).try_cast(types[c]).isNull()
        aggs += [F.count_if(bad).alias(f"r{i}"), F.count_if(F.col(c).isNotNull() & ~bad).alias(f"a{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("target_type"),
                     F.col(f"r{i}").alias("rejected"), F.col(f"a{i}").alias("accepted"))
            for i, c in enumerate(names)]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def resolve_choice(df: DataFrame, specs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Settle columns whose values may not all be of one type.

    policy ``cast``: try_cast, unparsable -> NULL;
    ``split``: ``<c>_<type>`` holds parsed values and ``<c>_text`` the rest;
    ``keep``: leave the column as text.
    """
    out = df
    for c, (typ, policy) in specs.items():
        parsed = F.col(c).try_cast(typ)
        if policy == "cast":
            out = out.withColumn(c, parsed)
        elif policy == "split":
            out = (out.withColumn(f"{c}_{typ}", parsed)
                      .withColumn(f"{c}_text", F.when(parsed.isNull(), F.col(c)))
                      .drop(c))
        elif policy != "keep":
            raise ValueError(f"unknown policy {policy!r}")
    return out


def apply_mapping(df: DataFrame, mapping: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """One projection from (source, source_type, target, target_type) tuples;
    unmapped columns are dropped."""
    return df.select(*[F.col(src).try_cast(tt).alias(dst) for src, _st, dst, tt in mapping])
