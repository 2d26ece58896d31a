"""Sharding by histogram sort: splitters from exact byte counts, then one exchange.

Documents are ordered by (MD5 of the text, MD5 of the id), as hex text, so equal texts stand side by side.
Candidate boundaries are key prefixes.  Each round counts the exact bytes of the cells two hex digits below the
prefixes that hold a splitter (at most 256 cells for each of the splitters, the only
rows that reach the driver) and goes on inside the cells hit, until each splitter is settled:

* at the nearer end of the group of equal texts that holds its byte, if that end is
  within ``TOLERANCE`` of a shard's ideal size, so that copies stay together;
* else at the nearer end of the row that holds its byte, so that one large group can't unbalance shards.

Slots follow (MD5 of the id, MD5 of the text) inside a shard; rows are numbered per bucket of the former, so no
task orders a whole shard.  Everything is DataFrame functions.

Defined results: null text has no bytes and the checksum of empty text; null ids order
as empty text; repeated rows are told apart by their place in the input; an empty
table gives an empty result; extra columns are carried under their names.
"""

from __future__ import annotations

import math
import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparklake.llm.common import ROW, field, packed, save, small

SHARDS = 16
LAW = "bytes"
#: Share of a shard's ideal size by which a splitter may miss it to keep equal texts together.
TOLERANCE = 0.01
DIGITS = 2
TEXT_DIGITS = 32
BUCKET_ROWS = 20_000
#: Sorts after every hex digit: ``key >= prefix + PAST`` holds for keys beyond the prefix.
PAST = "g"


def keyed(docs: DataFrame, carry_text: bool = True) -> DataFrame:
    """``__row``, size, text_crc32 and the sort key parts of each document."""
    text = F.coalesce(field(docs, "text"), F.lit(""))
    uid = F.lpad(F.lower(F.hex(F.monotonically_increasing_id())), 16, "0")
    return docs.select(packed(docs, () if carry_text else ("text",)), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.md5(text).alias("by_text"),
                       F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("by_id"), uid.alias("uid"))


def _histogram(rows: DataFrame, prefixes: list[str]) -> dict[str, list]:
    """Cells below each prefix, in key order: (first key, last key, rows, bytes)."""
    prefix = F.lit(None).cast("string")
    for p in prefixes:  # disjoint, at most one a splitter
        prefix = F.when(F.col("key").startswith(p), F.lit(p)).otherwise(prefix)
    found = rows.select("key", "size", prefix.alias("prefix")).where("prefix IS NOT NULL")
    # a cell never reaches from the digits of the text into those of the id
    cell = F.expr(f"substring(key, 1, if(length(prefix) < {TEXT_DIGITS}, least(length(prefix) + {DIGITS}, {TEXT_DIGITS}), "
                  f"length(prefix) + {DIGITS}))")
    cells = found.groupBy("prefix", cell.alias("cell")).agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.count("*").alias("n"), F.sum("size").alias("bytes"))
    out: dict[str, list] = {p: [] for p in prefixes}
    for r in sorted(cells.collect(), key=lambda r: r["first"]):
        out[r["prefix"]].append((r["first"], r["last"], r["n"], r["bytes"]))
    return out


def splitters(rows: DataFrame, shards: int, tolerance: float) -> list[str]:
    """``shards - 1`` keys: a row is in shard s if s of them are at or below its key."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    room = tolerance * total / shards
    state = [("", 0)] * (shards - 1)  # prefix that holds the splitter's byte, bytes below it
    settled: list[str | None] = [None] * (shards - 1)
    while None in settled:
        open_ = [i for i, s in enumerate(settled) if s is None]
        cells = _histogram(rows, sorted({state[i][0] for i in open_}))
        for i in open_:
            prefix, below = state[i]
            target = total * (i + 1) / shards
            for first, last, n, size in cells[prefix]:
                if target < below + size:
                    break
                below += size
            nearer_start = target - below <= below + size - target
            miss = min(target - below, below + size - target)
            common = os.path.commonprefix([first, last])
            one_text = len(prefix) < TEXT_DIGITS <= len(common)  # the cell is a whole group of equal texts
            if n == 1:
                settled[i] = first if nearer_start else first + PAST
            elif one_text and miss <= room:
                settled[i] = first[:TEXT_DIGITS] + ("" if nearer_start else PAST)
            else:
                state[i] = (common[:TEXT_DIGITS] if one_text else common), below
    return settled


def sharded(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, carry_text: bool = True) -> DataFrame:
    """``__row``, size, text_crc32, shard and slot (gapless from 0 in each shard)."""
    rows = save(keyed(docs, carry_text), "shard").withColumn("key", F.concat("by_text", "by_id", "uid"))
    cuts = splitters(rows, shards, tolerance)
    shard: Column = F.lit(0)
    for cut in cuts:
        shard = shard + F.when(F.col("key") >= cut, 1).otherwise(0)
    n = rows.count()
    digits = max(0, math.ceil(math.log(max(1, n) / (shards * BUCKET_ROWS), 16)))
    rows = rows.select(
        "*", shard.cast("int").alias("shard"), F.substring("by_id", 1, digits).alias("bucket")).drop("key")
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = save(counts.select("shard", "bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before")), "shard_buckets")
    inside = Window.partitionBy("shard", "bucket").orderBy("by_id", "by_text", "uid")
    numbered = rows.withColumn("at", F.row_number().over(inside) - 1)
    return numbered.join(small(before), ["shard", "bucket"]).select(
        ROW, "size", "text_crc32", "shard", (F.col("before") + F.col("at")).alias("slot"))


def digest(docs: DataFrame) -> DataFrame:
    return sharded(docs.select("doc_id", "text"), carry_text=False).select(
        F.col(ROW)["doc_id"].alias("doc_id"), "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
