"""Spelling variants: words one edit apart, found through an index of variable-length grams.

1. Words and their counts: distinct words are counted in each worker, then summed by Spark.
2. Gram dictionary: all grams of LEAST_GRAM to MOST_GRAM characters are counted over the distinct words (each
   between a begin and an end mark); those that occur more often than a threshold are *frequent*.  The threshold
   is at least LEAST_FREQUENT and grows with the number of gram places, so fewer than MOST_FREQUENT grams of each length can be above
   it: that bounds what the driver gathers and the workers get, whatever the input's size.
3. Decomposition: from each place of a word goes one gram, the shortest one that isn't frequent, ends with
   the end mark or has MOST_GRAM characters.  It depends on the characters that it spans and on nothing else,
   so an edit affects only grams that span its place.
4. Bounds: the most grams that any one place of the word is spanned by is the most that an edit affects, m.
   Of two words one edit apart the grams unaffected in one are those unaffected in the other, at the same
   place or the next.  In the order of frequency, at least one of the first m + 1 grams of each is then
   shared, so only those lists are merged.
5. The lists are merged by a join on gram, length and place; Spark verifies each pair inside the join by its
   edit distance, so that only near pairs leave it.  A hot list is a skewed join key, which AQE splits.

Words are compared by code points.

Defined results: null and empty texts have no words; a null doc_id counts as an empty one; repeated rows count again;
an empty table gives an empty result; ties go to the smallest word in code-point order; texts are read whole; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklake.llm.common import field, save, ship
from sparklake.llm.pieces import sliced

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LETTERS, LEAST_COUNT = 5, 3
LEAST_GRAM, MOST_GRAM = 2, 4
BEGIN, END = "^", "$"  # no letters
LEAST_FREQUENT, MOST_FREQUENT = 50, 50_000
#: Distinct words that a worker counts before it passes their counts on.
HELD_WORDS = 200_000
#: A 97th of the runs of a document loses a letter (see ``misspelt``).
MISSPELT_EVERY = 97
#: An edit can affect MOST_GRAM grams at most, and a word with its marks has enough for one more.
assert LEAST_LETTERS + 3 - LEAST_GRAM > MOST_GRAM


def misspelt(start: int, run: str) -> str:
    """The run without one letter, if its CRC-32 after ``start`` says so."""
    h = zlib.crc32(run.encode(), start)
    if h % MISSPELT_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least_letters: int = LEAST_LETTERS, misspell: bool = False) -> DataFrame:
    """(word, n): letter runs of all texts, lower-cased from A to Z, with their counts.

    ``misspell`` takes letters out of some runs by their document's id, as the contract of the query wants.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def passed_on() -> Iterator[pa.RecordBatch]:
            rest = iter(held.items())
            while part := list(islice(rest, 20_000)):
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in part], pa.string()), pa.array([n for _, n in part], pa.int64())],
                                                 names=["word", "n"])
            held.clear()

        for b in sliced(batches):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                if not text:
                    continue
                found = Counter(RUN.findall(text.lower().decode()))  # of bytes: lowers ASCII alone
                if misspell:
                    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for w, n in found.items():
                        w = misspelt(start, w)
                        if len(w) >= least_letters:
                            held[w] += n
                else:
                    held.update({w: n for w, n in found.items() if len(w) >= least_letters})
                if len(held) >= HELD_WORDS:
                    yield from passed_on()
        yield from passed_on()

    rows = docs.select(field(docs, "doc_id").cast("string").alias("doc_id"), field(docs, "text").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_grams(words: DataFrame, most: int = MOST_FREQUENT) -> dict[str, int]:
    """Grams that occur more often than the threshold, with their counts: fewer than ``most`` of each length."""
    marked = F.concat(F.lit(BEGIN), F.col("word"), F.lit(END))

    def of_length(k: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(marked) - (k - 1), F.lit(1)))
        return F.transform(places, lambda i: F.substring(marked, i, F.lit(k)))

    grams = F.concat(*[of_length(k) for k in range(LEAST_GRAM, MOST_GRAM + 1)])
    places = words.agg(F.sum(F.length("word") + 2)).first()[0] or 0  # over the gram places of each length
    threshold = max(LEAST_FREQUENT, -(-places // most))
    counts = words.select(F.explode(grams).alias("gram")).groupBy("gram").count().where(F.col("count") > threshold)
    return {gram: n for gram, n in counts.collect()}  # bounded: see above


def grams_of(word: str, frequent: dict[str, int] | set[str]) -> list[str]:
    """The gram from each place of the marked word."""
    marked = BEGIN + word + END
    out = []
    for at in range(len(marked) - LEAST_GRAM + 1):
        end = at + LEAST_GRAM
        while end - at < MOST_GRAM and end < len(marked) and marked[at:end] in frequent:
            end += 1
        out.append(marked[at:end])
    return out


def most_affected(grams: Iterable[str], letters: int) -> int:
    """The most grams that span one letter of the word."""
    edge = [0] * (letters + 3)
    for at, gram in enumerate(grams):
        edge[at] += 1
        edge[at + len(gram)] -= 1
    most = spanned = 0
    for at in range(letters + 1):
        spanned += edge[at]
        if at:
            most = max(most, spanned)
    return most


def listed(word: str, frequent: dict[str, int]) -> list[tuple[str, int]]:
    """(gram, place) of the lists that ``word`` is looked up in: the rarest, one more than an edit can affect."""
    grams = grams_of(word, frequent)
    order = sorted((frequent.get(g, 0), zlib.crc32(g.encode()), g, at) for at, g in enumerate(grams))
    return [(g, at) for _, _, g, at in order[:most_affected(grams, len(word)) + 1]]


def pair_bits(word: str) -> int:
    """64 bits: the parity of the numbers of letter pairs, by the pair's hash.

    A replaced letter changes four pairs, one put in or taken out three; so no more bits differ.
    """
    marked, bits = BEGIN + word + END, 0
    for a, b in zip(marked, marked[1:]):
        bits ^= 1 << (ord(a) * 31 + ord(b) * 17 & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def gram_lists(words: DataFrame) -> DataFrame:
    """(gram, letters, place, word, bits): the index."""
    spark = words.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(frequent_grams(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for b in batches:
            rows = [(g, len(w), at, w, bits) for w in b.column("word").to_pylist() for bits in [pair_bits(w)]
                    for g, at in listed(w, frequent)]
            if rows:
                columns = list(zip(*rows))
                kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 names=["gram", "letters", "place", "word", "bits"])

    return words.select("word").mapInArrow(run, "gram string, letters int, place int, word string, bits long")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): all pairs of words one edit apart, each once, the shorter first, then the smaller.

    ``words`` are distinct, without the marks, and of at least LEAST_LETTERS letters.
    """
    lists = save(gram_lists(words), "grams")
    # as long, at the same place; or one letter longer, at the same place or the next
    sought = F.array(*[F.struct((F.col("letters") + more).alias("letters"), (F.col("place") + on).alias("place"))
                       for more, on in ((0, 0), (1, 0), (1, 1))])
    a = lists.select("gram", F.col("word").alias("a"), F.col("letters").alias("a_letters"), F.col("bits").alias("a_bits"),
                     F.explode(sought).alias("s")).select("gram", "s.letters", "s.place", "a", "a_letters", "a_bits")
    b = lists.withColumnRenamed("word", "b")
    once = (F.col("a_letters") < F.col("letters")) | (F.col("a") < F.col("b"))
    alike = F.bit_count(F.col("a_bits").bitwiseXOR(F.col("bits"))) <= 4
    met = a.join(b, ["gram", "letters", "place"]).where(alike & once & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "b").distinct()  # a pair meets in several lists


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): where the chain of forms ends.  Chains have no cycles.

    Each round doubles the reach, so the rounds are the logarithm of the longest chain.
    """
    reached = save(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reached = save(reached.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not reached.where("moved").head(1):
            return reached.drop("moved")
        reached = reached.drop("moved")


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct words with counts (word, n).

    A word's form is its commonest near word, if that is at least twice as common; its root is where its forms lead.
    """
    words = save(words, "words")
    pairs = save(near_pairs(words), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")) \
                .union(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                       F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word"))).alias("best"))
    top: Column = -F.col("best.less")
    has_form = top >= 2 * F.col("n")
    found = save(words.join(best, "word", "left").select(
        "word", F.when(has_form, F.col("best.word")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has_form, top).alias("form_n")), "forms")
    led = roots(found.where("form IS NOT NULL"))
    return found.join(led, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def digest(docs: DataFrame) -> DataFrame:
    return variants(word_counts(docs, misspell=True).where(F.col("n") >= LEAST_COUNT))
