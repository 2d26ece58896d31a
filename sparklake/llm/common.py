"""Helpers shared by the operators: scratch tables, size-checked joins, packed rows."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklake.session import scratch_path

#: White space that separates words, everywhere in this subpackage.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
ROW = "__row"

#: A side is broadcast only if it was counted and has at most this many narrow rows.
BROADCAST_ROWS = 500_000


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts lineage with a written table: a lost executor re-reads files, and every later
    use sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows, else as it is.

    ``df`` should be a written table, as it is counted here.  Beyond the limit Spark
    plans a shuffle join, whose hot keys AQE splits.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(docs: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """All columns of ``docs`` as one struct, so that no name can clash with a work column."""
    names = [c for c in docs.columns if c not in without]
    return F.struct(*[F.col(quoted(c)) for c in names]).alias(ROW)


def unpacked(docs: DataFrame, names: list[str]) -> list[Column]:
    return [F.col(ROW).getField(c).alias(c) for c in names]


def field(docs: DataFrame, name: str, kind: str = "string") -> Column:
    """The column ``name`` of ``docs``; nulls of type ``kind`` if it has none."""
    return F.col(quoted(name)) if name in docs.columns else F.lit(None).cast(kind)


def content_key(docs: DataFrame, names: list[str]) -> list[Column]:
    """Two independent 64-bit hashes, ``key_a`` and ``key_b``, of the columns ``names``.

    A decision that depends on these columns alone is carried back to the rows by this key,
    so that no stage has to write the texts a second time.
    """
    one = [field(docs, n) for n in names]
    return [F.xxhash64(F.lit(1), *one).alias("key_a"), F.xxhash64(F.lit(2), *reversed(one)).alias("key_b")]


KEY = ["key_a", "key_b"]


def with_key(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` as a struct column ``__row`` with its content key."""
    return docs.select(packed(docs), *content_key(docs, names))


def word_array(text: Column) -> Column:
    """Words of a text, in order; null and empty text: none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def utf8_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, unless PYTHONPATH already names its folder."""
    root = Path(__file__).resolve().parents[2]
    sc = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_sparklake_sent", False):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="sparklake-code-"), "sparklake_code")
    sc.addPyFile(shutil.make_archive(base, "zip", root, "sparklake"))  # Spark's file server hands it out
    sc._sparklake_sent = True
