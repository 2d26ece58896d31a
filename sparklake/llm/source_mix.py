"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

* Each source's documents, in a fixed pseudo-random order, are one stream of words, cut
  into blocks of equal size (the last may be shorter).
* Slot i of the schedule takes the golden-ratio point frac(i * phi) and the source whose
  interval of cumulative weights holds it.  The r-th slot of a source takes block r of its
  stream, going round again after the last block.  So every stretch of the mix has the
  sources near their weights, and the whole has each within a few blocks of its target.
* What a source's slots take is what the mix has of it, in whole blocks, as long as that is within
  ``SLACK`` of its target.  Only a source so small that a few blocks are more than that is brought to its target: slots
  after the last one fill what is missing, or its last block is cut there.

Weights: sources in code-point order, null last, weigh 5, 2, 1, repeating, and share 150 %
of all words.  A target stops at twice its source's words; the excess goes to the others
by weight.  Ranks and positions are counted per chunk or bucket first, so that a hot source is
never ordered in one task.  The order depends on the rows alone, so reruns agree.

Defined results: null and blank texts have size 0, are never taken, and count as documents of their
source; null is a source of its own; equal (doc_id, text) rows are taken in turn;
very long texts are spread over the blocks they fill;
an empty table gives an empty result; extra columns are carried under their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparklake.llm.common import KEY, content_key, field, save, small, unpacked, with_key

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_REPEATS = 2
WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 0.6180339887498949
#: A schedule has about this many slots; beyond MOST_BLOCK_WORDS a block it grows with the input.
SLOTS = 1 << 18
MOST_BLOCK_WORDS = 1024
#: How far the words of a source's slots may be from its target, as a share of it.
SLACK = 0.01
CHUNK_SLOTS = 1 << 13
GRID = 1 << 12
BUCKET_ROWS = 2_000


READ = ["doc_id", "text", "source"]


def _sized(docs: DataFrame) -> DataFrame:
    """doc_id, content key, source, size, and a key that orders each source's documents; no texts."""
    text = F.coalesce(field(docs, "text"), F.lit(""))
    key = F.concat_ws("\x01", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    return docs.select("doc_id", *content_key(docs, READ), field(docs, "source").alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.md5(key).alias("order"),
                       F.monotonically_increasing_id().alias("uid"))


def targets(sources: DataFrame) -> DataFrame:
    """(source, words) -> with rank, weight, target and the interval [low, high) of all targets.

    Water filling: a target is min(most, level * weight).  With the sources in the order of
    most / weight, (total - most of those before) / (weights of the rest) rises up to the
    level and falls after it.  One row a source: a narrow table.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS)).cast("int") + 1)
    t = sources.select("*", rank.alias("rank"), weight.alias("weight"), (MOST_REPEATS * F.col("words")).alias("most"))
    before = Window.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("words").over(whole) * SHARE_PERCENT / 100 - F.coalesce(F.sum("most").over(before), F.lit(0)))
             / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    t = t.withColumn("level", level).withColumn("level", F.max("level").over(whole))
    t = t.withColumn("target", F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")))
    upto = Window.orderBy("rank")
    return t.select("source", "rank", "words", "weight", "target", F.sum("target").over(whole).alias("all"),
                    F.coalesce(F.sum("target").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("low"),
                    F.sum("target").over(upto).alias("high"))


def _running(rows: DataFrame, keys: list[str], cell: str, order: list[Column | str], amount: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``amount`` over earlier rows of the same keys, in the order of (cell, order).

    Cells are summed first, so a window never holds more than one cell, or one row a cell.
    """
    cells = rows.groupBy(*keys, cell).agg(F.sum(amount).alias("__cell"))
    w = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*[F.col(k).alias(f"__{k}") for k in [*keys, cell]],
                         F.coalesce(F.sum("__cell").over(w), F.lit(0)).alias("__before"))
    match = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in [*keys, cell]]
    inside = Window.partitionBy(*keys, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.withColumn("__inside", F.coalesce(F.sum(amount).over(inside), F.lit(0))).join(
        small(save(cells, "mix_cells")), match)
    return joined.withColumn(name, F.col("__before") + F.col("__inside")).drop(
        "__inside", "__before", *[f"__{k}" for k in [*keys, cell]])


def schedule(sources: DataFrame, slots: int, block: int) -> DataFrame:
    """(slot, rank, turn, whole): the source that each slot takes, and its how-manieth slot that is.

    ``slots`` slots follow the points.  ``whole`` says that the source's blocks stand as drawn; else its slots are
    to be cut at the target, and those that it lacks come after all others (slot null).
    """
    drawn = sources.sparkSession.range(slots).select(
        F.col("id").alias("slot"), F.floor(F.col("id") / CHUNK_SLOTS).alias("chunk"),
        (F.col("id") * GOLDEN - F.floor(F.col("id") * GOLDEN)).alias("point"))
    open_ = sources.where("target > 0")
    # intervals by grid cell, so that points meet them by an equal key
    spans = open_.select("rank", (F.col("low") / F.col("all")).alias("a"), (F.col("high") / F.col("all")).alias("b"))
    spans = spans.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("a") * GRID), F.least(F.floor(F.col("b") * GRID), F.lit(GRID - 1).cast("long")))))
    drawn = drawn.withColumn("cell", F.floor(F.col("point") * GRID)).join(small(save(spans, "mix_spans")), "cell")
    drawn = drawn.where("point >= a AND point < b").select("slot", "rank", "chunk", F.lit(1).cast("long").alias("one"))
    drawn = _running(drawn, ["rank"], "chunk", ["slot"], "one", "turn").select("slot", "rank", "turn")
    drawn = save(drawn, "mix_slots")
    have = save(drawn.groupBy("rank").agg(F.count("*").alias("have")), "mix_have")
    blocks = F.ceil(F.col("words") / block)
    got = F.least(F.coalesce("have", F.lit(0).cast("long")), MOST_REPEATS * blocks)
    taken_ = F.floor(got / blocks) * F.col("words") + (got % blocks) * block
    state = small(save(open_.join(small(have), "rank", "left").select(
        "rank", got.alias("have"), _turns(block).alias("need"),
        (F.abs(taken_ - F.col("target")) <= SLACK * F.col("target")).alias("whole")), "mix_state"))
    lacking = state.where("NOT whole AND have < need").select(
        F.lit(None).cast("long").alias("slot"), "rank", F.explode(F.sequence(F.col("have"), F.col("need") - 1)).alias("turn"), "whole")
    return drawn.join(state.select("rank", "whole"), "rank").select("slot", "rank", "turn", "whole").unionByName(lacking)


def _turns(block: int) -> Column:
    """Slots that a source needs for its target; the last block of each round may be short."""
    more = F.col("target") - F.col("words")
    return F.when(more <= 0, F.ceil(F.col("target") / block)).otherwise(
        F.ceil(F.col("words") / block) + F.ceil(more / block))


def mix(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): the documents with their source's figures, and the mix itself.

    ``rows``: doc_id, content key, source, uid, size, source_size, target.  ``spans``: slot, uid, turn, first and last
    (exclusive) word of the document; ordered by slot they are the mix.
    """
    sized = save(_sized(docs), "mix")
    n, words = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    sources = save(targets(sized.groupBy("source").agg(F.sum("size").alias("words"))), "mix_sources")
    all_words = -(-words * SHARE_PERCENT // 100)
    block = max(1, min(MOST_BLOCK_WORDS, all_words // SLOTS))
    buckets = max(1, n // BUCKET_ROWS)
    known = sources.select(F.col("source").alias("__source"), "rank", F.col("words").alias("source_size"), "target")
    rows = sized.join(small(known), F.col("source").eqNullSafe(F.col("__source"))).select(
        "doc_id", *KEY, "source", "uid", "size", "rank", "source_size", "target", "order")
    streams = rows.where("size > 0").select("uid", "size", "rank", "source_size", "target", "order", F.pmod(
        F.conv(F.substring("order", 1, 8), 16, 10).cast("long"), F.lit(buckets)).alias("bucket"))
    streams = _running(streams, ["rank"], "bucket", ["order", "uid"], "size", "start")
    parts = streams.select("uid", "start", (F.col("start") + F.col("size")).alias("end"), "rank", "source_size", "target",
                           F.explode(F.sequence(F.floor(F.col("start") / block),
                                                F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    turns = schedule(sources, -(-all_words // block), block).join(small(sources.select("rank", "words")), "rank")
    blocks = F.ceil(F.col("words") / block)
    turns = turns.select("slot", "rank", "turn", "whole", F.floor(F.col("turn") / blocks).alias("round"), (F.col("turn") % blocks).alias("block"))
    first = F.greatest(F.col("start"), F.col("block") * block)
    # the words of a round that come before the target is met, where that cuts
    limit = F.when(~F.col("whole"), F.round("target").cast("long") - F.col("round") * F.col("source_size"))
    last = F.least(F.col("end"), (F.col("block") + 1) * block, limit)
    spans = parts.join(turns.where(F.col("round") < MOST_REPEATS), ["rank", "block"]).select(
        "slot", "uid", "turn", (first - F.col("start")).alias("first"), (last - F.col("start")).alias("last"))
    return rows.select("doc_id", *KEY, "source", "uid", "size", "source_size", "target"), spans.where("first < last")


def taken(docs: DataFrame) -> DataFrame:
    """(doc_id, content key, size, source_size, target, taken, first_slot): the words of each document in the mix, and
    the slot that takes its first ones (NULL if none does)."""
    rows, spans = mix(docs)
    got = save(spans.groupBy("uid").agg(F.sum(F.col("last") - F.col("first")).alias("taken"), F.min("slot").alias("first_slot")), "mix_taken")
    return rows.join(small(got), "uid", "left").select(
        "doc_id", *KEY, "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "first_slot")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, with their own columns: each as often as the mix has it, to the nearest
    whole (rows that are equal in id, text and source: as often as they are on average)."""
    times = F.floor(F.avg("taken") / F.greatest(F.max("size"), F.lit(1)) + 0.5).cast("int")
    per_key = save(taken(docs).groupBy(*KEY).agg(times.alias("__times")).where("__times > 0"), "mix_times")
    return (with_key(docs, READ).join(small(per_key), KEY).withColumn("__time", F.explode(F.array_repeat(F.lit(0), F.col("__times"))))
            .select(*unpacked(docs, docs.columns)))


def digest(docs: DataFrame) -> DataFrame:
    return taken(docs).select("doc_id", "size", "source_size", "target", "taken", "first_slot")
