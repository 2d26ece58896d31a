"""N-gram Jaccard join: signature trees over distinct 5-word shingles, exact at 0.8.

1. Rows of one word sequence form a class; classes, not copies, are joined.
2. A token that no other class holds can match nobody, so a class with over 20 % of such
   tokens links with nothing.  Tokens are counted over all documents; large documents
   count a fixed part of the hash space that every possible partner counts too.
3. The classes left get their whole sets.  Two that link share a token of their prefixes:
   the least frequent tokens, one more than a fifth of the set.  Classes connected
   by shared prefix tokens form a family; nothing links across families.
4. Each family gets a signature tree (``signature_tree``), whose dual traversal finds the links.
   A family too large for one task is cut into blocks: trees of the blocks, then a
   tree of a few delegates of each part found, and last each block against those
   documents that are not yet in the family's main part.  No pair is left out.

Tokens are 64-bit hashes of shingles.  Defined results: A-Z are lower-cased, words are split at ASCII white space;
fewer than five words are one shingle; null, empty or blank texts have none and are
alone; a null doc_id is never the smallest id of a component; repeated rows are one
class; an empty table gives an empty result; extra columns are carried under their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparklake.llm import signature_tree
from sparklake.llm.common import KEY, content_key, field, save, ship, small, unpacked, with_key
from sparklake.llm.components import components

SHINGLE = 5
#: Below each size (in tokens), the part of the hash space that is counted.
PARTS = ((128, 1.0), (512, 0.5), (2048, 0.3), (1 << 62, 0.25))
#: Most tokens of a family, or of a block of a larger one, in one task.
BLOCK_TOKENS = 2_000_000
#: Documents of each part of a block that go on as its delegates.
DELEGATES = 4
WORDS_KEPT = 100_000

_SALT = np.uint64(0x9E3779B97F4A7C15)
_word_hashes: dict[bytes, int] = {}


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # bytes: both are about ASCII only


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct hashes (unsigned) of the shingles of a word sequence."""
    if not words:
        return np.empty(0, np.uint64)
    kept = _word_hashes
    if len(kept) > WORDS_KEPT:
        kept.clear()
    for w in set(words).difference(kept):
        kept[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter((kept[w] for w in words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    count = len(words) - width + 1
    out = np.full(count, width, np.uint64)
    for i in range(width):
        out = out * _SALT + h[i:i + count]
    return np.unique(_mixed(out))


def class_of(words: list[bytes]) -> str:
    return hashlib.md5(b" ".join(words)).hexdigest()


def _limit(size: int) -> np.uint64:
    part = next(p for top, p in PARTS if size <= top)
    return np.uint64(min(int(part * 2.0 ** 64), 2 ** 64 - 1))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate([*arrays, np.empty(0, np.uint64)]).view(np.int64)
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat)).cast(pa.list_(pa.int64()))


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _counted_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, content key) -> (doc_id, content key, class, key, n, tokens, tested).

    ``tokens`` is the counted part of the set in the order of hashes, ``tested`` how many of
    them every partner of up to 1.25 times the size counts as well.
    """
    for b in _pieces(batches):
        names, keys, sizes, tokens, tested = [], [], [], [], []
        for text in b.column("text").to_pylist():
            words = words_of(text)
            s = shingles(words)
            names.append(name := class_of(words))
            keys.append(int(name[:16], 16) - 2 ** 63)
            sizes.append(len(s))
            tokens.append(s[:np.searchsorted(s, _limit(len(s)), "right")])
            tested.append(int(np.searchsorted(s, _limit(-(-len(s) * 100 // signature_tree.PERCENT)), "right")))
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("doc_id", *KEY)), pa.array(names, pa.string()), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
             _lists(tokens), pa.array(tested, pa.int32())],
            names=["doc_id", *KEY, "class", "key", "n", "tokens", "tested"])


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(wanted class, key, text) -> (key, n, tokens) of the rows that are of that class."""
    for b in _pieces(batches):
        keys, sets = [], []
        for wanted, key, text in zip(*(b.column(c).to_pylist() for c in ("class", "key", "text"))):
            words = words_of(text)
            if class_of(words) == wanted:
                keys.append(key)
                sets.append(shingles(words))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(map(len, sets), pa.int64()), _lists(sets)],
                                         names=["key", "n", "tokens"])


def _alone(tokens: DataFrame) -> DataFrame:
    """(key, alone): how many tested tokens of a class no other class holds."""
    per_token = tokens.groupBy("token").agg(F.min("key").alias("key"), F.max("key").alias("other"),
                                            F.max("tested").alias("tested"))
    return per_token.where("key = other AND tested").groupBy("key").agg(F.count("*").alias("alone"))


def _may_link(size: str, alone: str):
    # |x \ y| >= alone, so |x & y| <= n - alone while |x | y| >= n
    return 100 * (F.col(size) - F.coalesce(F.col(alone), F.lit(0))) >= signature_tree.PERCENT * F.col(size)


def candidates(rows: DataFrame) -> DataFrame:
    """(class, key, n, content key, repeated) of the classes that may link.

    The content key is that of one of their texts, the least; ``repeated``: several rows have it.
    """
    classes = (rows.where("n > 0").groupBy("class", "key", *KEY).agg(F.min("n").alias("n"), F.count("*").alias("rows"))
               .groupBy("class", "key").agg(F.min("n").alias("n"), F.min(F.struct(*KEY, "rows")).alias("one")))
    tokens = rows.select("key", F.posexplode("tokens").alias("at", "token"), "tested").select(
        "key", "token", (F.col("at") < F.col("tested")).alias("tested"))
    kept = classes.join(_alone(tokens), "key", "left").where(_may_link("n", "alone"))
    return kept.select("class", "key", "n", *[F.col(f"one.{k}").alias(k) for k in KEY], (F.col("one.rows") > 1).alias("repeated"))


def wanted_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, key, text): one row of docs (doc_id, text) for each wanted class, found by its content key."""
    keyed = docs.select("text", *content_key(docs, ["doc_id", "text"]))
    found = keyed.join(small(wanted.select("class", "key", *KEY, "repeated")), KEY)
    again = found.where("repeated").dropDuplicates(KEY)  # equal rows: one of them serves
    return found.where("NOT repeated").unionByName(again).select("class", "key", "text")


def whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, n, tokens) of the wanted classes."""
    return wanted_texts(docs, wanted).mapInArrow(_whole_sets, "key long, n long, tokens array<long>")


def prefixes(sets: DataFrame) -> DataFrame:
    """(key, token): the shared tokens of each set's prefix, in the order of (frequency, token)."""
    tokens = sets.select("key", "n", F.explode("tokens").alias("token"))
    shared = (tokens.groupBy("token").agg(F.min("key").alias("a"), F.max("key").alias("b"), F.count("*").alias("df"))
              .where("a < b").select("token", "df"))
    held = tokens.join(save(shared, "near_shared"), "token")
    order = Window.partitionBy("key").orderBy("df", "token")
    per_set = Window.partitionBy("key")
    ranked = held.select("*", F.row_number().over(order).alias("rank"), F.count("*").over(per_set).alias("shared"))
    # the n - shared tokens of this set alone come first and match nobody
    prefix = F.col("n") - F.ceil(F.col("n") * signature_tree.PERCENT / 100) + 1
    return ranked.where(F.col("rank") <= prefix - (F.col("n") - F.col("shared"))).select("key", "token")


def families(postings: DataFrame) -> DataFrame:
    """(key, family): classes connected by shared prefix tokens."""
    first = postings.groupBy("token").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a < b")
    edges = postings.join(save(first.select("token", "a"), "near_first"), "token").select("a", F.col("key").alias("b"))
    found = components(edges.where("a <> b").distinct())
    return found.select(F.col("node").alias("key"), F.col("root").alias("family"))


def _links(_, group: pd.DataFrame) -> pd.DataFrame:
    """(key, part): the component of each document of one tree."""
    group = group.drop_duplicates("key").sort_values("key")
    keys = group["key"].to_numpy()
    root = signature_tree.link([np.sort(np.asarray(t, np.int64)) for t in group["tokens"]], group["part"].to_numpy())
    first = pd.Series(keys).groupby(root).transform("min").to_numpy()
    return pd.DataFrame({"key": keys, "part": first})


def _trees(rows: DataFrame, by: list[str]) -> DataFrame:
    return save(rows.groupBy(*by).applyInPandas(lambda k, g: _links(k, g), "key long, part long"), "near_parts")


def _blocks(tokens, limit: int):
    """Number of blocks: one up to the limit, else so many that half the limit is usual."""
    return F.when(tokens <= limit, F.lit(1)).otherwise(F.ceil(tokens / (limit / 2))).cast("int")


def _block(count: str):
    return F.pmod(F.xxhash64("key"), F.col(count)).cast("int")


def linked_classes(sets: DataFrame, limit: int = BLOCK_TOKENS) -> DataFrame:
    """(key, part) of the classes that link with another: equal parts are one component."""
    family = families(save(prefixes(sets), "near_postings"))
    rows = save(sets.join(small(family), "key"), "near_rows")
    size = rows.groupBy("family").agg(F.sum("n").alias("tokens"))
    size = save(size.select("family", _blocks(F.col("tokens"), limit).alias("blocks")), "near_families")
    rows = rows.join(small(size), "family").withColumn("block", _block("blocks"))
    parts = _trees(rows.withColumn("part", F.col("key")), ["family", "block"])
    large = rows.where("blocks > 1")
    if not size.where("blocks > 1").limit(1).count():
        return parts
    large = save(large.join(parts, "key"), "near_large")
    # delegates of each block's parts, in as many trees as their tokens need
    order = Window.partitionBy("family", "block", "part").orderBy(F.xxhash64("key"))
    few = save(large.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= DELEGATES), "near_few")
    trees = few.groupBy("family").agg(_blocks(F.sum("n"), limit).alias("trees"))
    few = few.join(small(save(trees, "near_trees")), "family").withColumn("tree", _block("trees"))
    met = _trees(few, ["family", "tree"])
    edges = parts.unionByName(met).select(F.col("key").alias("a"), F.col("part").alias("b"))
    now = components(edges)
    large = save(large.drop("part").join(now.withColumnRenamed("node", "key"), "key", "left")
                 .withColumn("part", F.coalesce("root", "key")).drop("root"), "near_large")
    main = (large.groupBy("family", "part").agg(F.count("*").alias("c"))
            .groupBy("family").agg(F.max_by("part", F.struct("c", "part")).alias("main")))
    large = large.join(small(save(main, "near_main")), "family").withColumn("rest", F.col("part") != F.col("main"))
    rest = large.where("rest").groupBy("family").agg(_blocks(F.sum("n"), limit).alias("chunks"))
    large = large.join(small(save(rest, "near_rest")), "family")  # a family in one part is done
    large = large.withColumn("chunk", _block("chunks"))
    every_chunk = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    mains = large.where("NOT rest").select("*", every_chunk.alias("j"), F.col("block").alias("i"), F.lit("main").alias("kind"))
    others = large.where("rest")
    to_mains = others.select("*", F.col("chunk").alias("j"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"),
                             F.lit("main").alias("kind"))
    paired = others.select("*", every_chunk.alias("k")).select(
        "*", F.greatest("chunk", "k").alias("j"), F.least("chunk", "k").alias("i"), F.lit("rest").alias("kind")).drop("k")
    last = _trees(mains.unionByName(to_mains).unionByName(paired).select("family", "kind", "i", "j", "key", "part", "tokens"),
                  ["family", "kind", "i", "j"])
    all_edges = edges.union(last.select("key", "part"))
    joined = components(all_edges)
    return joined.select(F.col("node").alias("key"), F.col("root").alias("part"))


def with_components(docs: DataFrame) -> DataFrame:
    """(doc_id, content key, n_shingles, component, component_id) of docs (doc_id, text).

    ``component`` names the component (null: the row is alone); ``component_id`` is its smallest doc_id.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", "text", *content_key(docs, ["doc_id", "text"]))
    rows = save(keyed.mapInArrow(_counted_tokens, f"doc_id {kind}, key_a long, key_b long, class string, key long, n long, "
                                                  "tokens array<long>, tested int"), "near")
    wanted = save(candidates(rows), "near_candidates")
    sets = save(whole_sets(docs.select("doc_id", "text"), wanted), "near_sets")
    parts = linked_classes(sets)
    classes = rows.where("n > 0").groupBy("class", "key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    joined = classes.join(parts, "key", "left").select(
        "class", "first", "copies", F.when(F.col("part").isNotNull(), F.format_string("%d", "part"))
        .otherwise(F.col("class")).alias("component"))
    joined = save(joined, "near_classes")
    found = joined.groupBy("component").agg(F.min("first").alias("component_id"), F.sum("copies").alias("members"))
    found = joined.join(found.where("members > 1"), "component").select("class", "component", "component_id")
    # many rows of one class are split by AQE; the other side has a row a class
    return rows.join(small(save(found, "near_found")), "class", "left").select(
        "doc_id", *KEY, F.col("n").alias("n_shingles"), "component",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component (smallest doc_id, null ids last), with its own columns."""
    names = ["doc_id", "text"]
    rows = docs.select(F.col("doc_id"), field(docs, "text").alias("text"))
    found = with_components(rows).where(F.col("component").isNotNull())
    found = save(found.select("doc_id", "component", *KEY), "near_result")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *KEY))
    kept = found.groupBy("component").agg(first.alias("first")).select(F.col("first.key_a").alias("key_a"), F.col("first.key_b").alias("key_b"))
    keys = found.groupBy(*KEY).agg(F.count("*").alias("rows"))
    dropped = save(keys.join(kept, KEY, "left_anti").select(*KEY), "near_dropped")
    again = save(keys.where("rows > 1").join(kept, KEY, "left_semi").select(*KEY), "near_again")
    left = with_key(docs, names).join(small(dropped), KEY, "left_anti")
    if again.limit(1).count():  # rows that equal the kept one in id and text: one of them stays
        once = left.join(small(again), KEY, "left_semi").dropDuplicates(KEY)
        left = left.join(small(again), KEY, "left_anti").unionByName(once)
    return left.select(*unpacked(docs, docs.columns))


def digest(docs: DataFrame) -> DataFrame:
    return with_components(docs.select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")
