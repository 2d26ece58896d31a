"""Exact dedup: two-pass Bloom filtering; only possibly repeated rows take the exact path.

Pass 1 counts how often each filter cell is hit (two cells a row, within one block of
32,768 bits) and keeps the cells hit twice or more as bitmaps, one row a block.  Pass 2
tests every row against the broadcast bitmaps: a row with a cell that nobody else hit
has no copy and passes straight through; only the others are grouped by their hash.
False positives cost a little shuffle and change no result.

The filter has about ``BITS_PER_ROW`` bits a row and never more than ``MAX_BLOCKS``
blocks (64 MB broadcast, 536 million bits).  Beyond that it gets denser: more rows take the exact path, the result
is the same.

Everything is DataFrame functions.  Texts are equal when their white-space-normalised
texts have the same SHA-256.

Defined results: null text counts as empty, and empty texts are copies of each other;
of equal texts the row with the smallest doc_id stays, null ids last; of repeated rows
with that id exactly one stays; an empty table gives an empty result; extra
columns are carried under their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklake.llm.common import ROW, SPACE, field, packed, save, small, unpacked

BITS_PER_ROW = 16
BLOCK_BITS = 32_768
MAX_BLOCKS = 16_384


def repeated_cells(rows: DataFrame) -> DataFrame:
    """(block, bits): a bitmap of the cells hit twice or more, for blocks that have any."""
    cells = rows.select("block", F.explode(F.array("bit1", "bit2")).alias("bit"))
    twice = cells.groupBy("block", "bit").agg(F.count("*").alias("hits")).where("hits >= 2")
    return twice.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit")).alias("bits"))


def _is_set(bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring("bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))


def _sha(docs: DataFrame) -> Column:
    text = F.regexp_replace(F.coalesce(field(docs, "text"), F.lit("")), SPACE, " ")
    return F.sha2(text, 256).alias("text_sha256")


class Filter:
    """The filter of a table of hashes, and the groups of those it finds possibly repeated."""

    def __init__(self, hashes: DataFrame):
        """``hashes``: a written table of (doc_id, text_sha256)."""
        self.blocks = max(1, min(MAX_BLOCKS, -(-hashes.count() * BITS_PER_ROW // BLOCK_BITS)))
        placed = self._placed(hashes).select("block", "bit1", "bit2")
        self.cells = save(repeated_cells(placed), "dedup_cells")
        maybe = self.tested(hashes).where("maybe")
        known = F.min("doc_id")  # leaves nulls out
        found = maybe.groupBy("text_sha256").agg(known.alias("keep_id"), F.count("*").alias("group_size"))
        self.groups = save(found.where("group_size >= 2"), "dedup_groups")

    def _placed(self, rows: DataFrame) -> DataFrame:
        h = F.xxhash64("text_sha256")
        return rows.select("*", F.pmod(h, F.lit(self.blocks)).alias("block"),
                           F.pmod(F.shiftright(h, 20), F.lit(BLOCK_BITS)).alias("bit1"),
                           F.pmod(F.shiftright(h, 40), F.lit(BLOCK_BITS)).alias("bit2"))

    def tested(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with text_sha256) with maybe: whether a row may have a copy."""
        # at most MAX_BLOCKS rows of 4 KB: the bound of this broadcast
        hit = self._placed(rows).join(F.broadcast(self.cells), "block", "left")
        return hit.withColumn("maybe", _is_set(F.col("bit1")) & _is_set(F.col("bit2"))).drop("block", "bit1", "bit2", "bits")


def resolved(rows: DataFrame, found: Filter) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those without a copy, and the others with keep_id and group_size."""
    tested = found.tested(rows)
    # a hot group is one row of `groups`; its many rows on the other side are split by AQE
    return tested.where(~F.col("maybe")).drop("maybe"), tested.where("maybe").drop("maybe").join(
        small(found.groups), "text_sha256", "left")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group of equal texts, with its own columns."""
    found = Filter(save(docs.select(_id(docs), _sha(docs)), "dedup"))
    alone, maybe = resolved(docs.select(packed(docs), _id(docs), _sha(docs)), found)
    single = maybe.where("group_size IS NULL").select(ROW)
    # one row a group, but for repeated rows with the smallest id
    first = maybe.where(F.col("group_size").isNotNull() & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    first = first.dropDuplicates(["text_sha256"]).select(ROW)
    return alone.select(ROW).union(single).union(first).select(*unpacked(docs, docs.columns))


def _id(docs: DataFrame) -> Column:
    return field(docs, "doc_id", "long").alias("doc_id")


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    hashes = save(docs.select(_id(docs), _sha(docs), F.monotonically_increasing_id().alias("uid")), "dedup")
    found = Filter(hashes)
    alone, maybe = resolved(hashes, found)
    alone = alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                         F.lit(True).alias("kept"), "text_sha256")
    # of repeated rows with the smallest id the first one stays
    stay = maybe.where(F.col("group_size").isNotNull() & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    stay = stay.groupBy("text_sha256").agg(F.min("uid").alias("stays"))
    maybe = maybe.join(small(save(stay, "dedup_stays")), "text_sha256", "left").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("uid") == F.col("stays"), F.lit(True)).alias("kept"), "text_sha256")
    return alone.unionByName(maybe)


ORACLE = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
